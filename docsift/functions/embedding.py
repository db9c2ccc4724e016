"""Default text embedding and vector distance as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let

DEFAULT_DIM = 64
DISTANCE_DIGITS = 9


def _letters(dim: int) -> str:
    """One distinct character per bucket (ASCII while they last)."""
    if not 1 <= dim <= 20_000:
        raise ValueError("1 to 20000 buckets")
    return "".join(chr(33 + i) if dim <= 94 else chr(0x4E00 + i) for i in range(dim))


def word_buckets(words: Column | str, dim: int = DEFAULT_DIM) -> Column:
    """A text with one letter per word: the first 32 bits of its MD5 modulo ``dim``."""
    letters = F.lit(_letters(dim))

    def letter(w: Column) -> Column:
        head = F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("bigint")
        return F.substr(letters, (F.pmod(head, F.lit(dim)) + 1).cast("int"), F.lit(1))

    return F.array_join(F.transform(col(words), letter), "")


def bucket_counts(buckets: Column | str, dim: int = DEFAULT_DIM) -> Column:
    """How often each letter occurs: what removing it takes off the length."""
    b = col(buckets)
    letters = F.array(*[F.lit(c) for c in _letters(dim)])
    return F.transform(letters, lambda c: (F.length(b) - F.length(F.replace(b, c, F.lit("")))).cast("double"))


def unit_vector(counts: Column | str) -> Column:
    """Length one, as floats; the zero vector stays zero."""
    c = col(counts)
    squares = F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)
    return let(
        F.struct(c.alias("c"), F.sqrt(squares).alias("norm")),
        lambda v: F.transform(
            v["c"], lambda x: F.when(v["norm"] > 0, x / v["norm"]).otherwise(0.0).cast("float")
        ),
    )


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """One minus the cosine, in doubles; null when either vector has no length."""
    x, y = col(a), col(b)
    norms = F.sqrt(_dot(x, x)) * F.sqrt(_dot(y, y))
    return F.when(norms > 0, F.lit(1.0) - _dot(x, y) / norms)


def rounded_distance(d: Column | str) -> Column:
    """Distances are ranked at nine digits so that ties do not hang on summation order."""
    r = F.round(col(d), DISTANCE_DIGITS)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)
