"""Scores read from model replies, their mean, bands and field comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip

# Score pattern, default for unreadable replies, thresholds and labels.
SCORE_PATTERN = r"(?U)\b(0\.[0-9]+|1\.0|0|1)\b"
DEFAULT_SCORE = 0.5
FLAG_THRESHOLD = 0.6
BAND_LOW = 0.85
BAND_NORMAL = 0.7
RECEIPT_FIELDS = ("company", "date", "address", "total")


def score_from_reply(reply: Column | str, default: float = DEFAULT_SCORE) -> Column:
    """First number from 0 to 1 in a reply; ``default`` where there is none."""
    found = F.nullif(F.regexp_extract(col(reply), SCORE_PATTERN, 1), F.lit(""))
    return F.coalesce(found.try_cast("double"), F.lit(default))


def has_empty(*inputs: Column | str) -> Column:
    """True where any input is null or empty: such rows score 0 without a judge call."""
    out = F.lit(False)
    for c in inputs:
        out = out | (F.coalesce(col(c), F.lit("")) == "")
    return out


def mean_score(*scores: Column | str) -> Column:
    total = col(scores[0])
    for s in scores[1:]:
        total = total + col(s)
    return total / F.lit(float(len(scores)))


def low_score(average: Column | str, threshold: float = FLAG_THRESHOLD) -> Column:
    """Flag on the unrounded mean."""
    return col(average) < F.lit(threshold)


def score_band(value: Column | str) -> Column:
    v = col(value)
    return F.when(v >= BAND_LOW, "low").when(v >= BAND_NORMAL, "normal").otherwise("urgent")


def percent_text(value: Column | str) -> Column:
    """``0.8462`` becomes ``84.6%`` (one digit, half up)."""
    tenths = F.floor(col(value) * 100 * 10 + F.lit(0.5)).cast("bigint")
    return F.concat(
        F.floor(tenths / 10).cast("bigint").cast("string"), F.lit("."),
        F.pmod(tenths, F.lit(10)).cast("string"), F.lit("%"),
    )


def clean_field(value: Column | str) -> Column:
    """Stripped and lower-cased; a missing value counts as empty."""
    return F.lower(strip(F.coalesce(col(value), F.lit(""))))


def field_score(predicted: Column | str, truth: Column | str) -> Column:
    """1 for equal, 0.5 where one holds the other, else 0; an empty label wants an empty value.

    The empty string lies in every text, so an empty value scores 0.5 against a label.
    """
    p, t = clean_field(predicted), clean_field(truth)
    return (
        F.when(t == "", F.when(p == "", 1.0).otherwise(0.0))
        .when(p == t, 1.0)
        .when(F.contains(t, p) | F.contains(p, t), 0.5)
        .otherwise(0.0)
    )


def receipt_scores(predicted: Column | str, truth: Column | str) -> Column:
    """Struct of one score per receipt field and their mean ``macro_f1``."""
    p, t = col(predicted), col(truth)
    each = [field_score(p[f], t[f]).alias(f) for f in RECEIPT_FIELDS]
    total = each[0]
    for c in each[1:]:
        total = total + c
    return F.struct(*each, (total / F.lit(4.0)).alias("macro_f1"))


def receipt_exact_match(predicted: Column | str, truth: Column | str) -> Column:
    p, t = col(predicted), col(truth)
    same = F.lit(True)
    for f in RECEIPT_FIELDS:
        same = same & (clean_field(p[f]) == clean_field(t[f]))
    return same
