"""Insert-only vector table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import global_index


def with_default_ids(batch: DataFrame, id_col: str = "id", order: list[Column | str] | None = None) -> DataFrame:
    """Rows without an id get ``doc_{i}``, ``i`` being their place in the batch.

    The place follows ``order`` (by default all other columns but maps), so that the same batch gets the same ids
    again. Null columns come first; rows that tie on the whole order are equal and take the places
    in any way. Without the id column all rows are without an id. Ids become texts.
    """
    if id_col not in batch.columns:
        batch = batch.withColumn(id_col, F.lit(None).cast("string"))
    others = [f.name for f in batch.schema.fields if f.name != id_col and "map<" not in f.dataType.simpleString()]
    placed = global_index(batch.withColumn(id_col, F.col(id_col).cast("string")), [*(order or others), id_col], "_place")
    default = F.concat(F.lit("doc_"), F.col("_place").cast("string"))
    return placed.withColumn(id_col, F.coalesce(id_col, default)).select(*batch.columns)


def unique_ids(batch: DataFrame, id_col: str = "id") -> DataFrame:
    """The batch, failing when an id occurs twice in it."""
    others = [c for c in batch.columns if c != id_col]
    grouped = batch.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_row")
    )
    bad = F.raise_error(F.concat(F.lit("id occurs twice in one batch: "), F.col(id_col).cast("string")))
    checked = F.when(F.col("_n") > 1, bad.cast("bigint")).otherwise(F.col("_n"))
    return grouped.withColumn("_n", checked).where(F.col("_n") == 1).select(
        id_col, *[F.col("_row")[c].alias(c) for c in others]
    ).select(*batch.columns)


def new_rows(batch: DataFrame, table: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id the table does not hold; a stored row is never replaced."""
    return unique_ids(batch, id_col).join(table.select(id_col), on=id_col, how="left_anti")
