"""Roll-up of a model call log: in one pass, or from days that are stored and merged later."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed prices in dollars per million tokens.
INPUT_PRICE = 0.15
OUTPUT_PRICE = 0.60
STEP = 1.02  # ratio of the bounds of a sketch's bucket: its middle is within 1 % of every value in it
NONE = -(1 << 30)  # bucket of latencies that are not above zero


def _bucket(latency: Column) -> Column:
    return F.when(latency > 0, F.floor(F.log(latency) / F.lit(math.log(STEP)))).otherwise(F.lit(NONE)).cast("int")


def _middle(bucket: Column) -> Column:
    """The value that is off by one share from both bounds of the bucket."""
    return F.when(bucket == NONE, F.lit(0.0)).otherwise(F.pow(F.lit(STEP), bucket + 1) * (2 / (1 + STEP)))


def call_days(log: DataFrame, day: Column | str, by: list[str] | None = None) -> DataFrame:
    """One row per day and prompt version that can be merged with others of its kind.

    Holds counts and sums, the greatest latency, and a sketch of the latencies: how many fall into
    each bucket of the logarithm. Latencies from a microsecond to a day make at most 1,300 buckets.
    Null latencies are left out of the sketch. Counts combine before the shuffle.
    """
    keys = by or ["prompt_version"]
    marked = log.withColumn("day", F.col(day) if isinstance(day, str) else day).withColumn(
        "_bucket", F.when(F.col("latency").isNotNull(), _bucket(F.col("latency").cast("double")))
    )
    buckets = marked.groupBy(*keys, "day", "_bucket").agg(
        F.count(F.lit(1)).alias("calls"), F.count("latency").alias("timed"), F.sum("latency").alias("latency_sum"),
        F.max("latency").alias("latency_max"), F.sum("tokens_in").cast("bigint").alias("tokens_in"),
        F.sum("tokens_out").cast("bigint").alias("tokens_out"), F.count("error").alias("told"),
        F.sum(F.col("error").cast("int")).cast("bigint").alias("errors"),
    )
    pair = F.when(F.col("_bucket").isNotNull(), F.struct(F.col("_bucket").alias("bucket"), F.col("calls").alias("n")))
    sums = [F.sum(c).alias(c) for c in ("calls", "timed", "latency_sum", "tokens_in", "tokens_out", "told", "errors")]
    return buckets.groupBy(*keys, "day").agg(*sums, F.max("latency_max").alias("latency_max"), F.array_sort(F.collect_list(pair)).alias("sketch"))


def _quantile(sketch: Column, share: float) -> Column:
    """Middle of the bucket that holds the value of rank ``ceil(share * n)``; ``sketch`` is in bucket order."""
    total = F.aggregate(sketch, F.lit(0).cast("bigint"), lambda s, b: s + b["n"])
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("bucket"))

    def step(state: Column, b: Column) -> Column:
        seen = state["seen"] + b["n"]
        here = state["bucket"].isNull() & (seen >= F.ceil(total * F.lit(share)))
        return F.struct(seen.alias("seen"), F.when(here, b["bucket"]).otherwise(state["bucket"]).alias("bucket"))

    return _middle(F.aggregate(sketch, start, step)["bucket"])


def merge_call_days(
    days: DataFrame, by: list[str] | None = None, input_price: float = INPUT_PRICE, output_price: float = OUTPUT_PRICE
) -> DataFrame:
    """Calls, latency, tokens, cost and error rate per prompt version over all given days.

    ``p95_latency`` is within 1 % of the exact value of rank ``ceil(0.95 * n)``, and the same
    however the calls were cut into days.
    """
    keys = by or ["prompt_version"]
    sketches = (
        days.select(*keys, F.inline("sketch")).groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
        .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("_sketch"))
    )
    sums = days.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("calls", "timed", "latency_sum", "tokens_in", "tokens_out", "told", "errors")],
        F.max("latency_max").alias("max_latency"),
    )
    same = [sums[k].eqNullSafe(sketches[k]) for k in keys]
    joined = sums.join(sketches.select(*keys, "_sketch"), on=_all(same), how="left")
    return joined.select(
        *[sums[k] for k in keys],
        "calls",
        F.try_divide("latency_sum", "timed").alias("avg_latency"),
        "max_latency",
        _quantile(F.col("_sketch"), 0.95).alias("p95_latency"),
        "tokens_in",
        "tokens_out",
        ((F.col("tokens_in") * input_price + F.col("tokens_out") * output_price) / 1e6).alias("cost"),
        F.try_divide(F.col("errors").cast("double"), F.col("told")).alias("error_rate"),
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def call_stats(
    log: DataFrame, by: list[str] | None = None, input_price: float = INPUT_PRICE, output_price: float = OUTPUT_PRICE
) -> DataFrame:
    """Calls, latency, tokens, cost and error rate per prompt version.

    The log has ``latency, tokens_in, tokens_out, error``; input and output tokens are
    priced apart. The same as ``merge_call_days`` over its days.
    """
    return merge_call_days(call_days(log, F.lit("all"), by), by, input_price, output_price)
