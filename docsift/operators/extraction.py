"""Receipts: pairing with labels, normalising, extraction with a fallback, scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions.parsing import json_fields, labels_json, object_text, question_answer_pairs, receipt_struct
from ..functions.scores import RECEIPT_FIELDS, receipt_exact_match, receipt_scores
from ..functions.text import training_text
from .chunks import mark_unverified
from .model import TEMPERATURE_QA, TEMPERATURE_RECEIPT, Model, complete
from .order import cap_pairs


def pair_by_stem(
    texts: DataFrame, labels: DataFrame, text_suffix: str = ".txt", label_suffix: str = ".json", name: str = "name"
) -> DataFrame:
    """Texts with the labels of the same file stem; the rest drops. Column ``stem`` gives the order."""

    def stem(suffix: str):
        return F.expr(f"substring({name}, 1, length({name}) - {len(suffix)})")

    left = texts.where(F.endswith(name, F.lit(text_suffix))).withColumn("stem", stem(text_suffix)).drop(name)
    right = labels.where(F.endswith(name, F.lit(label_suffix))).withColumn("stem", stem(label_suffix)).drop(name)
    return left.join(right, on="stem", how="inner")


def normalise_receipts(df: DataFrame) -> DataFrame:
    """``input`` from ``text`` or else the ``words``; ``output`` the four labels as JSON text."""
    text = F.col("text") if "text" in df.columns else F.lit(None).cast("string")
    joined = F.array_join("words", " ") if "words" in df.columns else F.lit(None).cast("string")
    labels = F.struct(
        *[
            (F.coalesce(F.col(f).cast("string"), F.lit("")) if f in df.columns else F.lit("")).alias(f)
            for f in RECEIPT_FIELDS
        ]
    )
    dropped = {"text", "words", *RECEIPT_FIELDS}
    return df.select(
        *[c for c in df.columns if c not in dropped],
        F.coalesce(text, joined, F.lit("")).alias("input"),
        labels_json(labels).alias("output"),
    )


def with_training_text(records: DataFrame, max_words: int | None = None) -> DataFrame:
    return records.withColumn("training_text", training_text("input", "output", max_words))


def score_extractions(pred: DataFrame, gold: DataFrame, on: str = "receipt_id") -> DataFrame:
    """Field scores and exact match per labelled receipt; a missing prediction counts as empty.

    Both sides carry a struct column ``fields``. One row per labelled receipt: of several
    predictions the least by its fields counts.
    """
    p = pred.groupBy(on).agg(F.min("fields").alias("predicted"))
    g = gold.select(on, F.col("fields").alias("gold"))
    joined = g.join(p, on=on, how="left")
    return joined.select(
        on,
        receipt_scores("predicted", "gold").alias("_scores"),
        receipt_exact_match("predicted", "gold").alias("exact_match"),
    ).select(on, "_scores.*", "exact_match")


def extraction_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n_receipts"),
        *[F.avg(f).alias(f"avg_{f}") for f in RECEIPT_FIELDS],
        F.avg("macro_f1").alias("field_f1"),
        F.avg(F.col("exact_match").cast("double")).alias("exact_match"),
    )


def extract(
    receipts: DataFrame,
    primary: Model | None = None,
    fallback: Model | None = None,
    text: str = "receipt_text",
    primary_name: str = "fine-tuned-local",
    fallback_name: str = "api-fallback",
    **call,
) -> DataFrame:
    """Adds ``fields, raw_output, model, requires_review, error``.

    The primary's reply is cut from the first to the last brace; a reply without braces is
    kept as ``raw_output``. Rows the primary fails on go to the fallback, whose reply must
    be one JSON object and always asks for review. Without a model the row says so.
    """
    base = list(receipts.columns)
    asked = receipts.withColumn("_prompt_text", prompts.receipt_prompt(text))
    # Replies are read twice (kept rows, rows for the fallback), so they are stored.
    options = {"temperature": TEMPERATURE_RECEIPT, "on_error": "null", "keep": True, **call}
    none = F.lit(None).cast("string")
    done = None
    todo = asked
    if primary is not None:
        called = complete(asked, "_prompt_text", primary, **options)
        cut = object_text("reply")
        called = called.withColumn("_cut", cut).withColumn("_map", json_fields("_cut"))
        failed = F.col("reply").isNull() | (F.col("_cut").isNotNull() & F.col("_map").isNull())
        called = called.withColumn("_failed", failed)
        ok = called.where(~F.col("_failed"))
        fields = F.when(F.col("_map").isNotNull(), receipt_struct("_map"))
        done = ok.select(
            *base, fields.alias("fields"), F.when(F.col("_cut").isNull(), F.col("reply")).alias("raw_output"),
            F.lit(primary_name).alias("model"), F.lit(False).alias("requires_review"), none.alias("error"),
        )
        todo = called.where("_failed").withColumn(
            "_why", F.coalesce("reply_error", F.lit("reply holds no valid JSON object"))
        ).select(*base, "_prompt_text", "_why")
    if fallback is None:
        why = F.col("_why") if primary is not None else F.lit("no extraction model given")
        rest = todo.select(
            *base, F.lit(None).cast(_FIELDS).alias("fields"), none.alias("raw_output"), none.alias("model"),
            F.lit(True).alias("requires_review"), why.alias("error"),
        )
    else:
        called = complete(todo.select(*base, "_prompt_text"), "_prompt_text", fallback, **options)
        called = called.withColumn("_map", json_fields("reply"))
        error = F.when(F.col("_map").isNull(), F.coalesce("reply_error", F.lit("reply is not one JSON object")))
        rest = called.select(
            *base, F.when(F.col("_map").isNotNull(), receipt_struct("_map")).alias("fields"),
            F.when(F.col("_map").isNull(), F.coalesce("reply", F.lit(""))).alias("raw_output"),
            F.lit(fallback_name).alias("model"), F.lit(True).alias("requires_review"), error.alias("error"),
        )
    return rest if done is None else done.unionByName(rest)


_FIELDS = "struct<" + ",".join(f"{f}:string" for f in RECEIPT_FIELDS) + ">"


def generate_qa(
    sources: DataFrame,
    fn: Model,
    order: list[str],
    text: str = "text",
    num_pairs: int = 3,
    target_pairs: int | None = None,
    text_chars: int | None = None,
    **call,
) -> DataFrame:
    """Question-answer rows from texts, in source order, unverified; failures give none.

    ``target_pairs`` is the size of the wanted set (null keeps all pairs), ``text_chars`` the part of
    a text that is asked about (null: the whole).
    """
    asked = sources.withColumn("_ask", prompts.qa_prompt(text, num_pairs, text_chars))
    options = {"temperature": TEMPERATURE_QA, "on_error": "null", **call}
    replied = complete(asked, "_ask", fn, **options)
    pairs = replied.select(*order, F.posexplode(question_answer_pairs("reply")).alias("pair", "_qa")).select(
        *order, "pair", "_qa.question", "_qa.answer"
    )
    if target_pairs is not None:
        pairs = cap_pairs(pairs, [*order, "pair"], target_pairs)
    return mark_unverified(pairs)
