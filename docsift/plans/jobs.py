"""The seven user-level jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions.parsing import classification
from ..functions.scores import FLAG_THRESHOLD
from ..operators import chunks as ch
from ..operators import extraction as ex
from ..operators import layout as lay
from ..operators import mail as ml
from ..operators.context import build_context
from ..operators.embedding import embed
from ..operators.judge import attach_answers, evaluation_rows, flag_low, judge, summarise
from ..operators.model import TEMPERATURE_DEFAULT, TEMPERATURE_MAIL, Model, complete
from ..operators.order import global_index, ordered_split
from ..operators.search import search_chunks
from ..operators.skew import durable
from ..sources.readers import read_receipt_pairs
from ..sources.sinks import append_vectors, write_jsonl, write_run


def ingest(docs: DataFrame, path: str, fn=None, size: int = 512, overlap: int = 64) -> DataFrame:
    """Chunk, embed and add ``docs`` (text, source) to the vector table at ``path``; the manifest."""
    chunks = ch.chunk_documents(docs, size=size, overlap=overlap)
    append_vectors(embed(chunks, fn=fn), path)
    return ch.manifest(docs, size=size, overlap=overlap)


def answer(
    questions: DataFrame,
    vectors: DataFrame,
    fn: Model,
    k: int = 5,
    where: Column | None = None,
    embed_fn=None,
    **call,
) -> DataFrame:
    """``question_id, question`` to ``answer, retrieved_context, sources, chunks_used``."""
    asked = embed(questions, "question", embed_fn)
    context = build_context(questions, search_chunks(asked, vectors, k, where))
    prompted = context.withColumn("_ask", prompts.answer_prompt("question", "retrieved_context"))
    replied = complete(prompted, "_ask", fn, **{"temperature": TEMPERATURE_DEFAULT, "out": "answer", "keep": True, **call})
    return replied.drop("_ask")


def evaluate(
    qa: DataFrame,
    answers: DataFrame,
    fn: Model,
    threshold: float = FLAG_THRESHOLD,
    path: str | None = None,
    run_id: str | None = None,
    run_time: str | None = None,
    **call,
) -> tuple[DataFrame, DataFrame]:
    """(rows, summary) of one run; stored as ``results`` and ``aggregate`` under ``path``.

    ``qa`` has ``id, question, ground_truth``; ``answers`` is matched on ``question``.
    """
    paired = attach_answers(qa, answers)
    flagged = flag_low(judge(paired, fn, **{"keep": True, **call}), threshold)
    rows, summary = evaluation_rows(flagged), summarise(flagged)
    if path is not None:
        if run_id is None or run_time is None:
            raise ValueError("a stored run needs run_id and run_time")
        config = {"flag_threshold": str(threshold)}
        write_run(rows, f"{path}/results", run_id, run_time, config)
        write_run(summary, f"{path}/aggregate", run_id, run_time, config)
    return rows, summary


def number_questions(qa: DataFrame, order: list[str]) -> DataFrame:
    """QA rows as the evaluator wants them: 0-based ``id`` in the given order, answer as ``ground_truth``."""
    return global_index(qa, order, "id").withColumnRenamed("answer", "ground_truth")


def build_qa_set(chunks: DataFrame, fn: Model, path: str | None = None, target_pairs: int | None = None, per_file: int | None = None, **call) -> DataFrame:
    """``file, pos, text`` chunks to unverified question-answer rows.

    ``per_file`` chunks of a file are asked about and ``target_pairs`` pairs kept (null: all)."""
    sources = ch.qa_sources(chunks, ["file"], ["pos"], n=per_file)
    pairs = ex.generate_qa(sources, fn, ["file", "pos"], target_pairs=target_pairs, **call)
    out = pairs.select("question", "answer", "verified")
    if path is not None:
        write_jsonl(out, path)
    return out


def prepare_receipts(
    spark: SparkSession, path: str, out: str | None = None, val_split: float = 0.15, max_words: int | None = None
) -> DataFrame:
    """Receipt folder to training records with their split, in file order."""
    paired = ex.pair_by_stem(*read_receipt_pairs(spark, path))
    records = ex.with_training_text(ordered_split(paired, ["stem"], val_split), max_words)
    if out is not None:
        for name in ("train", "validation"):
            write_jsonl(records.where(F.col("split") == name).select("input", "output"), f"{out}/{name}")
    return records


def clear(tokens: DataFrame) -> DataFrame:
    """Layout tokens to clearance records; the links are stored, as three roll-ups read them."""
    return lay.clearance_records(tokens, durable(lay.link_boxes(tokens)))


def triage(mail: DataFrame, fn: Model, company: str | Column, **call) -> DataFrame:
    """Scan, sort and draft a reply for each mail; every draft wants approval.

    The sorting replies are stored before the drafts are asked for, so that each mail is
    drafted on the reply it shows.
    """
    options = {"temperature": TEMPERATURE_MAIL, "keep": True, **call}
    scanned = ml.scan_mail(mail, company)
    sort = scanned.withColumn("_ask", prompts.classify_prompt("contextual_text"))
    sorted_mail = complete(sort, "_ask", fn, **{**options, "out": "classification"}).drop("classification_error")
    draft = sorted_mail.withColumn("_ask", prompts.reply_prompt("contextual_text", "classification"))
    drafted = complete(draft, "_ask", fn, **{**options, "out": "response"}).drop("response_error", "_ask")
    return drafted.withColumn("_c", classification("classification")).select(
        *mail.columns, "classification", F.col("_c.priority").alias("priority"), F.col("_c.type").alias("type"),
        "response", "privacy_scan", F.lit(True).alias("requires_approval"),
    )


def revise(drafts: DataFrame, fn: Model, **call) -> DataFrame:
    """A new draft for each row with feedback (``email_text, response, feedback, revision_count``)."""
    has = F.coalesce("feedback", F.lit("")) != ""
    asked = drafts.withColumn("_ask", F.when(has, prompts.revise_prompt("feedback", "response", "email_text")))
    replied = complete(asked, "_ask", fn, **{"temperature": TEMPERATURE_MAIL, "out": "_new", "keep": True, **call})
    return replied.select(
        *[c for c in drafts.columns if c not in ("response", "revision_count")],
        F.coalesce("_new", "response").alias("response"),
        (F.coalesce("revision_count", F.lit(0)) + has.cast("int")).alias("revision_count"),
    )
