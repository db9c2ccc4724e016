"""Corpus to chunk rows, manifest, QA sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import CHUNK_MIN_CHARS, CHUNK_OVERLAP, CHUNK_WORDS, chunk_texts
from .order import head_per_group


def chunk_documents(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    size: int = CHUNK_WORDS,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = CHUNK_MIN_CHARS,
) -> DataFrame:
    """One row per kept chunk: ``id, text, metadata{source, chunk_index}``.

    A narrow pipeline: no shuffle, and the index counts kept chunks only.
    """
    chunks = chunk_texts(text, size, overlap, min_chars)
    return docs.select(F.col(source).alias("_source"), F.posexplode(chunks).alias("_i", "text")).select(
        F.concat_ws("_chunk_", "_source", "_i").alias("id"),
        "text",
        F.struct(F.col("_source").alias("source"), F.col("_i").alias("chunk_index")).alias("metadata"),
    )


def manifest(
    docs: DataFrame,
    text: str = "text",
    size: int = CHUNK_WORDS,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = CHUNK_MIN_CHARS,
) -> DataFrame:
    """Documents (empty ones too) and chunks in one pass; no row without documents."""
    n_chunks = F.size(chunk_texts(text, size, overlap, min_chars)).cast("bigint")
    return docs.agg(
        F.count(F.lit(1)).alias("total_documents"), F.sum(n_chunks).alias("total_chunks")
    ).where(F.col("total_documents") > 0)


def qa_sources(
    chunks: DataFrame, file: list[str], order: list[str], text: str = "text", n: int | None = None, min_chars: int = 100
) -> DataFrame:
    """The first ``n`` chunks of each file (null: all), and of those the ones longer than ``min_chars``."""
    first = chunks if n is None else head_per_group(chunks, file, order, n)
    return first.where(F.length(text) > min_chars)


def mark_unverified(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("verified", F.lit(False))


def verified(pairs: DataFrame, verified_only: bool = False) -> DataFrame:
    """All pairs by default; the flag only filters when asked to."""
    return pairs.where(F.coalesce(F.col("verified"), F.lit(False))) if verified_only else pairs
