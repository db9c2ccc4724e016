"""Tables and files that grow by appending."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.review import correction_rows, feedback_rows
from ..operators.vector_table import new_rows, unique_ids, with_default_ids
from .readers import MANIFESTS, read_vectors, vector_parts


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, in a folder of part files."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_run(rows: DataFrame, path: str, run_id: str, run_time: str, config: dict[str, str] | None = None) -> None:
    """Rows (or the summary) of one evaluation run, appended under their ``run_id``."""
    pairs = [F.lit(x) for kv in sorted((config or {}).items()) for x in kv]
    settings = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    stamped = (
        rows.withColumn("run_id", F.lit(run_id))
        .withColumn("run_time", F.lit(run_time).cast("timestamp"))
        .withColumn("config", settings)
    )
    stamped.write.mode("append").partitionBy("run_id").parquet(path)


def append_vectors(batch: DataFrame, path: str, id_col: str = "id", order: list[Column | str] | None = None) -> int:
    """Adds the rows with a new id and returns how many there are in the batch.

    Stored rows keep their value; an id twice in one batch fails before anything is written. Rows
    without an id get ``doc_{i}`` by their place in the batch (see ``with_default_ids``), so a
    batch appended twice is stored once.

    The rows go to a folder of their own first, which counts only once a manifest names it. Each
    append makes the manifest of the next number, listing all folders: a job that is killed leaves
    the table as it was, and of two at one time the later fails without a trace in the table. Read
    it with ``read_vectors``.
    """
    spark = batch.sparkSession
    named = batch
    if id_col not in batch.columns or not batch.where(F.col(id_col).isNull()).isEmpty():
        named = with_default_ids(batch, id_col, order)
    number, parts = vector_parts(spark, path)
    held = read_vectors(spark, path) if parts else None
    fresh = unique_ids(named, id_col) if held is None else new_rows(named, held, id_col)
    part = f"batch-{uuid.uuid4().hex}"
    fresh.write.parquet(f"{path}/{part}")
    name_vector_parts(spark, path, number + 1, [*parts, part])
    return batch.count()


def name_vector_parts(spark: SparkSession, path: str, number: int, parts: list[str]) -> None:
    """Writes manifest ``number``; fails where it exists. Its last line tells that it is whole."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}/{number:010d}")
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(jvm_path, False)
    out.write(bytearray("\n".join([*parts, f"{len(parts)} parts", ""]).encode()))
    out.close()


def append_feedback(df: DataFrame, path: str) -> None:
    feedback_rows(df).write.mode("append").parquet(path)


def append_corrections(df: DataFrame, path: str) -> None:
    correction_rows(df).write.mode("append").parquet(path)
