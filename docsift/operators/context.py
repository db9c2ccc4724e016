"""Hits to numbered context with sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def build_context(
    questions: DataFrame, hits: DataFrame, question_id: str = "question_id", text: str = "text"
) -> DataFrame:
    """``retrieved_context, sources, chunks_used`` per question; empty where nothing was found.

    A question has at most ``k`` hits, which bounds the lists.
    """
    has_metadata = "metadata" in hits.columns
    metadata = F.col("metadata") if has_metadata else F.lit(None).cast("string")
    hit = F.struct("rank", F.col(text).alias("content"), metadata.alias("metadata"), "distance")
    lists = hits.groupBy(question_id).agg(F.array_sort(F.collect_list(hit)).alias("_hits"))
    joined = questions.join(lists, on=question_id, how="left")
    numbered = F.transform(
        "_hits", lambda h: F.concat(F.lit("["), h["rank"].cast("string"), F.lit("] "), h["content"])
    )
    sources = F.transform(
        "_hits",
        lambda h: F.struct(
            h["rank"].cast("int").alias("chunk_id"), h["metadata"].alias("metadata"),
            h["content"].alias("content"), h["distance"].alias("score"),
        ),
    )
    return joined.select(
        *questions.columns,
        F.coalesce(F.array_join(numbered, "\n\n"), F.lit("")).alias("retrieved_context"),
        F.coalesce(sources, F.array()).alias("sources"),
        F.coalesce(F.size("_hits"), F.lit(0)).alias("chunks_used"),
    )


def source_card(source: Column, page: Column, section: Column, content: Column, chars: int | None = None) -> Column:
    """Struct ``source, place, excerpt`` for showing one cited chunk.

    The excerpt is the first ``chars`` characters, with dots where there are more (null: the whole text).
    """

    def filled(c: Column) -> Column:
        return F.nullif(c.cast("string"), F.lit(""))

    body = F.coalesce(content, F.lit(""))
    excerpt = body if chars is None else F.concat(F.substring(body, 1, chars), F.when(F.length(body) > chars, "...").otherwise(""))
    return F.struct(
        F.coalesce(filled(source), F.lit("Unknown")).alias("source"),
        F.coalesce(filled(page), filled(section), F.lit("N/A")).alias("place"),
        excerpt.alias("excerpt"),
    )


def source_cards(
    df: DataFrame, source: Column, page: Column, section: Column, content: Column, chars: int | None = None
) -> DataFrame:
    card = source_card(source, page, section, content, chars)
    return df.withColumn("_card", card).select(*df.columns, "_card.*")
