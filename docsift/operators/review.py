"""Human review: one queue, and what reviewers hand back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reasons named for flagged answers (others are accepted).
FEEDBACK_REASONS = ("bad_answer", "missing_source", "other")


def queue_item(df: DataFrame, kind: str, item: Column, reason: Column, score: Column | None = None) -> DataFrame:
    """Rows of ``kind, item_id, reason, score`` for the queue."""
    return df.select(
        F.lit(kind).alias("kind"), item.cast("string").alias("item_id"), reason.cast("string").alias("reason"),
        (F.lit(None) if score is None else score).cast("double").alias("score"),
    )


def review_queue(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def required(name: str) -> Column:
    """A text that must be there: a null fails the job instead of losing the row."""
    bad = F.raise_error(F.lit(f"{name} is missing")).cast("string")
    return F.when(F.col(name).isNull(), bad).otherwise(F.col(name).cast("string")).alias(name)


def feedback_rows(df: DataFrame) -> DataFrame:
    """``question, answer, reason`` as texts, plus ``status``."""
    return df.select(required("question"), required("answer"), required("reason"), F.lit("flagged").alias("status"))


def correction_rows(df: DataFrame) -> DataFrame:
    return df.select(required("receipt_text"), "predicted", "corrected")


def extend_gold(gold: DataFrame, confirmed: DataFrame, on: str = "question") -> DataFrame:
    """Confirmed pairs whose question the set does not hold yet, added to it (duplicates kept)."""
    fresh = confirmed.select(*gold.columns).join(gold.select(on).distinct(), on=on, how="left_anti")
    return gold.unionByName(fresh.select(*gold.columns))


def extend_training(
    records: DataFrame, corrections: DataFrame, version: str = "version", key: str = "receipt_text"
) -> DataFrame:
    """Training records (``input, output``) with what reviewers confirmed or corrected.

    ``corrections`` has the receipt text, the ``predicted`` and ``corrected`` fields (structs) and a
    version. The fields of a review are the corrected ones, or the predicted ones it confirmed. Of
    several reviews of a receipt the latest wins (a null version is the oldest, at equal versions the
    greater JSON text); the rest is dropped before the shuffle. A reviewed receipt replaces the output of every
    record with its text, or is added once. Reviews without a text or any fields change nothing.
    Column ``reviewed`` tells the rows apart.
    """
    known = F.coalesce(F.to_json("corrected"), F.to_json("predicted"))
    usable = corrections.select(F.col(key).alias("input"), F.col(version).alias("_v"), known.alias("_fields")).where(
        F.col("input").isNotNull() & F.col("_fields").isNotNull()
    )
    # A struct is never null, so rows with a null version count too.
    latest = usable.groupBy("input").agg(F.max(F.struct("_v", "_fields")).alias("_last")).select("input", F.col("_last._fields").alias("_new"))
    joined = records.select("input", "output", F.lit(True).alias("_old")).join(latest, on="input", how="full")
    return joined.select(
        "input", F.coalesce("_new", "output").alias("output"), F.col("_new").isNotNull().alias("reviewed")
    )
