"""Words, strip, chunks and cuts with Python's whitespace rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.split() and str.strip() treat as white space (29 of them).
WHITESPACE = "".join(chr(i) for i in range(0x10000) if chr(i).isspace())
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

CHUNK_WORDS = 512
CHUNK_OVERLAP = 64
CHUNK_MIN_CHARS = 20


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (lambdas would repeat it)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column | str) -> Column:
    return F.array_remove(F.split(col(text), WHITESPACE_RUN), "")


def strip(text: Column | str) -> Column:
    return F.btrim(col(text), F.lit(WHITESPACE))


def unix_newlines(text: Column | str) -> Column:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``, as in a text-mode file read."""
    return F.regexp_replace(col(text), "\r\n?", "\n")


def truncate(text: Column | str, n: int | None) -> Column:
    return col(text) if n is None else F.substring(col(text), 1, n)


def chunk_texts(
    text: Column | str,
    size: int = CHUNK_WORDS,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = CHUNK_MIN_CHARS,
) -> Column:
    """Array of word windows: ``size`` words every ``size - overlap``, longer than ``min_chars``.

    A window starts at every step below the word count, so the last one may hold
    nothing but the overlap of the one before it.
    """
    if size < 1 or overlap < 0 or overlap >= size:
        raise ValueError("chunks need 0 <= overlap < size")
    step = size - overlap

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 1, F.lit(step))
        joined = F.transform(starts, lambda s: F.array_join(F.slice(w, s + 1, F.lit(size)), " "))
        kept = F.filter(joined, lambda c: F.length(c) > min_chars)
        return F.when(F.size(w) > 0, kept).otherwise(F.array().cast("array<string>"))

    return let(words(F.coalesce(col(text), F.lit(""))), windows)


def mail_body(message: Column | str) -> Column:
    """Text after the first blank line, stripped; the whole message where there is none."""
    m = col(message)
    at = F.instr(m, "\n\n")
    body = F.when(at > 0, F.substr(m, at + 2)).otherwise(m)
    return F.coalesce(strip(body), F.lit(""))


# Fixed format of the training text.
TRAINING_RECEIPT_HEAD = "### Receipt:\n"
TRAINING_FIELDS_HEAD = "\n\n### Extracted Fields:\n"


def training_text(receipt: Column | str, fields_json: Column | str, max_words: int | None = None) -> Column:
    """Receipt and fields sections, cut after ``max_words`` words (joined by blanks when cut; null: whole)."""
    whole = F.concat(
        F.lit(TRAINING_RECEIPT_HEAD), col(receipt), F.lit(TRAINING_FIELDS_HEAD), col(fields_json)
    )
    return whole if max_words is None else _cut(whole, max_words)


def _cut(text: Column, max_words: int) -> Column:
    return let(
        F.struct(text.alias("t"), words(text).alias("w")),
        lambda s: F.when(F.size(s["w"]) <= max_words, s["t"]).otherwise(
            F.array_join(F.slice(s["w"], 1, max_words), " ")
        ),
    )
