"""First rows per group, positions over a total order, ordered splits and caps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

RANGE_ROWS = 1_000_000  # rows of one range
RANGE_BYTES = 128 << 20  # of one range, before compression
MANY_RANGES = 512
BROADCAST_SHIFTS = 200_000  # rows of some tens of bytes
SMALL_LIMIT = 100_000


def best_per_group(df: DataFrame, keys: list[str], order: list[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group with their 1-based rank.

    Spark keeps ``k`` rows per group and task before the shuffle, so a hot group sends
    ``k`` rows per task. It only does so below its threshold; above it the first cut is
    made here, per slice of the group.
    """
    out = Window.partitionBy(*keys).orderBy(*order)
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k >= limit:
        slices = 64
        df = df.withColumn("_slice", F.pmod(F.xxhash64(*_plain(df)), F.lit(slices)))
        part = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = df.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= k).drop("_rn", "_slice")
    return df.withColumn(rank, F.row_number().over(out)).where(F.col(rank) <= k)


def head_per_group(df: DataFrame, group: list[str], order: list[Column | str], n: int) -> DataFrame:
    return best_per_group(df, group, order, n, rank="_head").drop("_head")


def _plain(df: DataFrame) -> list[str]:
    return [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def range_size(rows: int, range_rows: int) -> int:
    """Rows of a range: ``range_rows`` while that gives up to ``MANY_RANGES`` ranges, then more, up to
    ``RANGE_ROWS``. What the driver holds (a task's report, sampled keys, counts) goes with the number of ranges."""
    return max(range_rows, min(RANGE_ROWS, -(-rows // MANY_RANGES)))


def _width(df: DataFrame) -> Column:
    """About the bytes of a row."""
    wide = [f.name for f in df.schema.fields if f.dataType.simpleString() == "binary" or any(t in f.dataType.simpleString() for t in ("string", "char", "array<", "map<", "struct<"))]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)) for n in wide]
    return reduce(lambda a, b: a + b, sizes, F.lit(8 * len(df.columns))).cast("bigint")


def group_index(
    df: DataFrame,
    keys: list[str],
    order: list[Column | str],
    name: str = "index",
    base: int = 0,
    total: str | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Position of each row within its group over an order; with ``total``, also the group's number of rows.

    Spark cuts the rows into ranges of (keys, order), as many as the rows ask for (``range_size``, and no more
    than ``RANGE_BYTES`` in one, so that rows with long texts fill many), and sorts inside each. The ranged table is stored once, with every row's range and place in it, so a
    repeated task can't move a row. One prefix sum over the counts per range and group then turns
    places into positions. A group of any size is spread over as many ranges as it fills.

    Rows that tie on the whole order get their positions in any order, nulls come first. An empty
    table gives an empty result.
    """
    sort = [*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`") if isinstance(c, str) else c for c in order]]
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
    ranges = max(1, -(-n // range_size(n, range_rows)), -(-size // RANGE_BYTES))
    placed = df.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort)
    # The id holds the number of the range above bit 33 and the place inside it below.
    rows = stored(placed.withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    counts = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("_range").alias("_of"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + base).alias("_shift"),
        F.sum("_n").over(group).alias("_total"),
        *[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)],
    )
    if keys:  # one row per group and range: as many as there are groups, so the size is looked at
        shifts = stored(shifts)
        few = shifts.count() <= BROADCAST_SHIFTS
    else:
        few = ranges <= BROADCAST_SHIFTS
    same = F.col("_range") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}"))
    joined = rows.join(F.broadcast(shifts) if few else shifts, on=same, how="left")
    out = joined.withColumn(name, F.col("_at") + F.col("_shift"))
    if total is not None:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_at", "_range", "_of", "_shift", "_total", *[f"_key_{i}" for i in range(len(keys))])


def global_index(
    df: DataFrame, order: list[Column | str], name: str = "index", total: str | None = None, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """0-based position over an order, without pulling the table into one task."""
    return group_index(df, [], order, name, total=total, range_rows=range_rows)


def first_rows(df: DataFrame, order: list[str], limit: int | None, name: str | None = None) -> DataFrame:
    """The first ``limit`` rows of an order (null: all), with their position when ``name`` is given."""
    if limit is None:
        return df if name is None else global_index(df, order, name)
    top = df.orderBy(*order).limit(limit)
    if name is None:
        return top
    if limit <= SMALL_LIMIT:
        at = (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint")
        return top.withColumn(name, at)
    return global_index(top, order, name)


def ordered_split(
    df: DataFrame,
    order: list[Column | str],
    val_split: float = 0.15,
    name: str = "split",
    index: str = "index",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """The first ``int(n * (1 - val_split))`` rows are ``train``, the rest ``validation``."""
    at = global_index(df, order, index, total="_rows", range_rows=range_rows)
    train = F.floor(F.col("_rows").cast("double") * F.lit(1.0 - val_split))
    return at.withColumn(name, F.when(F.col(index) < train, "train").otherwise("validation")).drop("_rows")


def cap_pairs(pairs: DataFrame, order: list[str], target: int | None = None) -> DataFrame:
    """The first ``target`` pairs; all of them when it is null."""
    return first_rows(pairs, order, target)


def sample_corpus(
    df: DataFrame,
    order: list[str],
    text: str = "text",
    min_chars: int = 200,
    limit: int | None = None,
    name_format: str = "arxiv_%04d",
) -> DataFrame:
    """The first ``limit`` texts (null: all) longer than ``min_chars``, named by their position."""
    kept = first_rows(df.where(F.length(text) > min_chars), order, limit, "index")
    return kept.withColumn("name", F.format_string(name_format, F.col("index"))).drop("index")
