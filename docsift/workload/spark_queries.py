"""One query per operator over the test tables. All read whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing, privacy, routing, scores, text
from ..operators import calls, chunks, context, extraction, judge, layout, mail, order, review, search, vector_table
from ..operators.embedding import embed
from ..operators.model import complete
from ..plans import jobs
from . import stubs

COMPANY = "Support desk notes: refunds within 30 days, answers on working days."
CACHE_TAU = 0.35


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under unique file names."""
    return documents(spark, sf_dir).select(
        "doc_id", "lang", "text", F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".txt")).alias("source")
    )


def _chunks(spark, sf_dir):
    return chunks.chunk_documents(_files(spark, sf_dir))


def _nine(c: Column | str) -> Column:
    r = F.round(c, 9)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


# Retrieval


def chunk_documents(spark, sf_dir):
    return _chunks(spark, sf_dir).select(
        "id", "text", F.col("metadata.source").alias("source"),
        F.col("metadata.chunk_index").cast("bigint").alias("chunk_index"),
    )


def chunk_manifest(spark, sf_dir):
    return chunks.manifest(documents(spark, sf_dir))


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")


def _centroids(spark, sf_dir):
    """The mean vector of each label is the question asked of the table."""
    mean = F.array(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(64)])
    return _vectors(spark, sf_dir).groupBy(F.col("label").cast("bigint").alias("question_id")).agg(
        mean.alias("embedding")
    )


def vector_topk(spark, sf_dir):
    return search.vector_search(_centroids(spark, sf_dir), _vectors(spark, sf_dir), 5).select(
        "question_id", F.col("rank").cast("bigint").alias("rank"), "id", "distance"
    )


def vector_topk_filtered(spark, sf_dir):
    return search.vector_search(
        _centroids(spark, sf_dir), _vectors(spark, sf_dir), 5, where=F.col("label") >= 5
    ).select("question_id", F.col("rank").cast("bigint").alias("rank"), "id", "distance")


def vector_topk_cells(spark, sf_dir):
    """The same over 16 trained cells: nearest cells first, then those the bound leaves."""
    cells = search.build_cells(_vectors(spark, sf_dir), 16)
    return search.vector_search_cells(_centroids(spark, sf_dir), cells, 5).select(
        "question_id", F.col("rank").cast("bigint").alias("rank"), "id", "distance"
    )


def vector_neighbours(spark, sf_dir):
    """Every vector as a question to all of them, by the plan for two large sides."""
    vectors = _vectors(spark, sf_dir)
    asked = vectors.select(F.col("id").alias("question_id"), "embedding")
    return search.vector_search(asked, vectors, 4, plan="cells").select(
        "question_id", F.col("rank").cast("bigint").alias("rank"), "id", "distance"
    )


def _questions(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def rag_context(spark, sf_dir):
    """Chunk and embed the documents, find five chunks per question, number them as context."""
    questions = _questions(spark, sf_dir)
    found = _chunks(spark, sf_dir)
    hits = search.search_chunks(embed(questions, "question"), embed(found), 5, texts=found)
    ctx = context.build_context(questions, hits)
    cited = F.transform(
        "sources", lambda s: F.concat_ws("#", s["metadata"]["source"], s["metadata"]["chunk_index"])
    )
    return ctx.select(
        "question_id", "retrieved_context", F.array_join(cited, ";").alias("cited"),
        F.col("chunks_used").cast("bigint").alias("chunks_used"),
    )


def ingest_new_only(spark, sf_dir):
    """English documents are stored already; the batch holds all of them."""
    batch = _chunks(spark, sf_dir).select("id", "text")
    stored = chunks.chunk_documents(_files(spark, sf_dir).where(F.col("lang") == "en"))
    return vector_table.new_rows(batch, stored).select("id", F.length("text").cast("bigint").alias("n_chars"))


def _cache(spark, sf_dir, plan=None):
    prompts = documents(spark, sf_dir).select(F.col("doc_id").alias("question_id"), "text")
    cache = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("id"), F.col("text"), F.concat(F.lit("answer to "), F.col("item_id")).alias("answer")
    )
    return search.cached_answers(embed(prompts), embed(cache), CACHE_TAU, plan=plan)


def cached_answers(spark, sf_dir):
    return _cache(spark, sf_dir)[0]


def cached_answers_cells(spark, sf_dir):
    """The same by the plan for a large cache."""
    return _cache(spark, sf_dir, "cells")[0]


def cache_misses(spark, sf_dir):
    return _cache(spark, sf_dir)[1].select("question_id")


def rerank(spark, sf_dir):
    """Twenty hits per label scored again by the negative L1 distance, five kept."""
    questions, vectors = _centroids(spark, sf_dir), _vectors(spark, sf_dir)
    hits = search.vector_search(questions, vectors, 20)
    pairs = hits.join(questions.withColumnRenamed("embedding", "_q"), on="question_id").join(
        vectors.select("id", "embedding"), on="id"
    )
    gaps = F.zip_with("_q", "embedding", lambda a, b: F.abs(a - b.cast("double")))
    score = _nine(-F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))
    return search.rerank(pairs, score, 5).select(
        "question_id", F.col("rank").cast("bigint").alias("rank"), "id", "rerank_score"
    )


def source_cards(spark, sf_dir):
    docs = documents(spark, sf_dir)
    source = F.when(F.col("lang") != "es", F.col("source"))
    page = F.when(F.col("lang") == "de", F.col("n_chars").cast("string")).otherwise("")
    section = F.when(F.col("lang") == "fr", F.col("lang"))
    card = context.source_card(source, page, section, F.col("text"), chars=150)
    return docs.select("doc_id", card.alias("c")).select("doc_id", "c.source", "c.place", "c.excerpt")


# Evaluation


def score_parse(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", scores.score_from_reply("text").alias("score"))


def _scored(spark, sf_dir):
    """Labelled documents as QA pairs. Good ones are answered by their text in lower case, the calls
    for the others failed; toxic ones come back without context."""
    rows = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), on="doc_id")
    ask = F.concat(F.lit("What is said in "), "source", F.lit(" ("), "lang", F.lit("): "), "text", F.lit("?"))
    qa = order.global_index(rows.select("doc_id", ask.alias("question"), F.col("text").alias("ground_truth")), ["doc_id"], "id")
    answers = rows.where(F.col("quality") == 1).select(
        "doc_id", F.lower("text").alias("answer"),
        F.when(F.col("toxic") == 1, "").otherwise(F.col("text")).alias("retrieved_context"),
    )
    paired = judge.attach_answers(qa, answers, on="doc_id")
    return judge.flag_low(judge.judge(paired, stubs.overlap_judge(), keep=True))


def evaluate_rows(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "id", "doc_id", *judge.METRICS, _nine("average").alias("average"), "flagged"
    )


def _summary(spark, sf_dir):
    return judge.summarise(_scored(spark, sf_dir), digits=None)


def evaluate_summary(spark, sf_dir):
    return _summary(spark, sf_dir).select(
        "total_questions", *[_nine(f"avg_{m}").alias(f"avg_{m}") for m in judge.METRICS],
        "flagged_count", _nine("flag_rate").alias("flag_rate"),
    )


def judge_alignment(spark, sf_dir):
    out = judge.judge_alignment(_scored(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id", "average", "quality", range_rows=150)
    return out.select("n_pairs", *[F.round(c, 9).alias(c) for c in ("correlation", "mean_abs_gap", "spearman", "kendall")])


def context_precision(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = search.vector_search(_centroids(spark, sf_dir), vectors, 5)
    relevant = vectors.select(F.col("label").cast("bigint").alias("question_id"), "id")
    return judge.context_precision(hits, relevant, 5)


def target_check(spark, sf_dir):
    named = _summary(spark, sf_dir).select(*[F.col(f"avg_{m}").alias(m) for m in judge.METRICS])
    checked = judge.check_targets(named, {m: judge.TARGETS[m] for m in judge.METRICS})
    return checked.select("metric", _nine("value").alias("value"), "target", "met")


def score_bands(spark, sf_dir):
    value = F.lit(1.0) - F.col("l_discount") * 3
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        scores.score_band(value).alias("band"), scores.percent_text(value).alias("percent"),
    )


# Extraction and layout


def _receipts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    raw = {"company": F.col("p_name"), "date": F.col("p_brand"), "address": F.col("p_type"), "total": F.col("p_size").cast("string")}
    gold = part.select(F.col("p_partkey").alias("receipt_id"), F.struct(*[c.alias(n) for n, c in raw.items()]).alias("fields"))

    def changed(c: Column) -> Column:
        kind = F.col("p_partkey") % 5
        return (
            F.when(kind == 0, c).when(kind == 1, F.concat(F.lit("  "), F.upper(c), F.lit("\n")))
            .when(kind == 2, F.substring(c, 1, 3)).when(kind == 3, "").otherwise("zzz")
        )

    pred = part.select(F.col("p_partkey").alias("receipt_id"), F.struct(*[changed(c).alias(n) for n, c in raw.items()]).alias("fields"))
    return extraction.score_extractions(pred, gold)


def field_scores(spark, sf_dir):
    return _receipts(spark, sf_dir)


def exact_match_rate(spark, sf_dir):
    out = extraction.extraction_summary(_receipts(spark, sf_dir))
    return out.select("n_receipts", *[_nine(c).alias(c) for c in out.columns if c != "n_receipts"])


def _tokens(spark, sf_dir, doc: Column, box: Column | None = None):
    """Line items as boxes on a page: odd lines ask, even lines answer."""
    x = (F.col("l_partkey") * 13 + F.col("l_linenumber") * 31) % 900
    y = (F.col("l_suppkey") * 17 + F.col("l_quantity").cast("bigint") * 7) % 1200
    wide = F.col("l_quantity").cast("bigint") + 20
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    keys = [F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), cents]
    pos = F.concat_ws("-", F.lpad(keys[0].cast("string"), 2, "0"), *[F.lpad(k.cast("string"), 12, "0") for k in keys[1:]])
    return table(spark, sf_dir, "lineitem").select(
        doc.alias("doc_id"), pos.alias("token_pos"),
        F.concat(F.lit("part "), F.col("l_partkey")).alias("text"),
        F.when(F.col("l_linenumber") % 2 == 1, "QUESTION").otherwise("ANSWER").alias("label"),
        (F.array(x, y, x + wide, y + F.col("l_linenumber") + 10).cast("array<int>") if box is None else box).alias("box"),
        F.round(F.lit(1.0) - F.col("l_discount") * 2, 4).alias("confidence"),
    )


def _links(tokens):
    return layout.link_boxes(tokens).select("doc_id", "question_pos", "answer_pos", "answer", "confidence", "distance")


def box_links(spark, sf_dir):
    return _links(_tokens(spark, sf_dir, F.col("l_orderkey")))


def box_links_large(spark, sf_dir):
    """Three documents hold all the boxes."""
    return _links(_tokens(spark, sf_dir, F.col("l_returnflag")))


def box_links_wide(spark, sf_dir):
    """Three pages of 8,000,000 x 8,000,000; some boxes are missing."""
    x = (F.col("l_partkey") * 7919 + F.col("l_orderkey") * 31 + F.col("l_linenumber") * 104729) % 8_000_000
    y = (F.col("l_suppkey") * 15485863 + F.col("l_orderkey") * 17) % 8_000_000
    corners = F.array(x, y, x + F.col("l_linenumber"), y + F.col("l_linenumber") + 10).cast("array<int>")
    box = F.when(F.col("l_partkey") % 10 != 3, corners)
    return _links(_tokens(spark, sf_dir, F.col("l_returnflag"), box))


def document_clearance(spark, sf_dir):
    tokens = _tokens(spark, sf_dir, F.col("l_orderkey"))
    return layout.clear_documents(tokens, layout.link_boxes(tokens))


def clearance_records(spark, sf_dir):
    tokens = _tokens(spark, sf_dir, F.col("l_orderkey"))
    shown = F.transform("extracted_fields", lambda f: F.concat_ws("|", f["field_name"], f["value"], f["status"]))
    return jobs.clear(tokens).select("doc_id", "part", "document_status", F.array_join(shown, ";").alias("fields"))


def redaction_boxes(spark, sf_dir):
    tokens = _tokens(spark, sf_dir, F.col("l_orderkey"))
    boxes = layout.redaction_boxes(tokens, layout.link_boxes(tokens))
    return boxes.select("doc_id", *[F.col("box")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def confidence_route(spark, sf_dir):
    routed = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", routing.confidence_route(F.lit(1.0) - F.col("l_tax")).alias("route")
    )
    return routed.groupBy("l_returnflag", "route").agg(F.count(F.lit(1)).alias("n"))


def pair_by_stem(spark, sf_dir):
    texts = documents(spark, sf_dir).select(F.concat("doc_id", F.lit(".txt")).alias("name"), F.col("text").alias("input"))
    labels = table(spark, sf_dir, "labels").select(F.concat("doc_id", F.lit(".json")).alias("name"), "quality", "toxic")
    return extraction.pair_by_stem(texts, labels).select("stem", "input", "quality", "toxic")


def normalise_receipts(spark, sf_dir):
    rows = documents(spark, sf_dir).select(
        "doc_id", F.when(F.col("lang") == "en", F.col("text")).alias("text"), text.words("text").alias("words"),
        F.col("source").alias("company"), F.when(F.col("lang") != "de", F.col("lang")).alias("address"),
        F.col("n_chars").alias("total"),
    )
    out = extraction.normalise_receipts(rows).withColumn("_f", parsing.receipt_struct(parsing.json_fields("output")))
    return out.select("doc_id", "input", "_f.company", "_f.date", "_f.address", "_f.total")


def training_text(spark, sf_dir):
    records = documents(spark, sf_dir).select(
        "doc_id", F.col("text").alias("input"), F.concat(F.lit('{"lang": "'), "lang", F.lit('"}')).alias("output")
    )
    return extraction.with_training_text(records, 512).select("doc_id", "training_text")


def ordered_split(spark, sf_dir):
    return order.ordered_split(documents(spark, sf_dir).select("doc_id"), ["doc_id"])


def line_index(spark, sf_dir):
    """Every line's position by date, and by date among the lines of its flag, over ranges of 8,192 rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag")
    by = [F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_partkey"]
    placed = order.global_index(lines, by, "position", total="n_lines", range_rows=8192)
    return order.group_index(placed, ["l_returnflag"], by, "flag_position", total="n_flag", range_rows=8192)


def extract_fallback_stub(spark, sf_dir):
    receipts = documents(spark, sf_dir).select("doc_id", F.col("text").alias("receipt_text"))
    out = extraction.extract(receipts, stubs.receipt_model(False), stubs.receipt_model(True), backoff=0.0)
    return out.select(
        "doc_id", "fields.company", "fields.date", "fields.address", "fields.total",
        "raw_output", "model", "requires_review", "error",
    )


def field_json(spark, sf_dir):
    reply = F.concat(F.lit("Read: "), "props", F.lit(" and done"))
    cut = parsing.object_text(reply)
    return table(spark, sf_dir, "events").select(
        "event_id", cut.alias("cut"), parsing.json_fields(cut)["k"].cast("bigint").alias("k")
    )


# QA sets and corpus


def head_per_group(spark, sf_dir):
    return order.head_per_group(documents(spark, sf_dir).select("source", "doc_id"), ["source"], ["doc_id"], 20)


def corpus_sample(spark, sf_dir):
    return order.sample_corpus(documents(spark, sf_dir), ["doc_id"], limit=100).select("doc_id", "name")


def qa_sources(spark, sf_dir):
    docs = documents(spark, sf_dir).select("source", "doc_id", "text")
    return chunks.qa_sources(docs, ["source"], ["doc_id"], n=20).select("source", "doc_id", "text")


def generate_qa_stub(spark, sf_dir):
    sources = chunks.qa_sources(documents(spark, sf_dir).select("source", "doc_id", "text"), ["source"], ["doc_id"])
    return extraction.generate_qa(sources, stubs.qa_model(), ["source", "doc_id"]).select(
        "source", "doc_id", F.col("pair").cast("bigint").alias("pair"), "question", "answer", "verified"
    )


def cap_pairs(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("question"))
    return chunks.mark_unverified(order.cap_pairs(turns, ["conv_id", "turn"], 50))


def complete_stub(spark, sf_dir):
    """Many rows share a prompt; each prompt is sent once."""
    rows = documents(spark, sf_dir).select("doc_id", F.concat_ws(" of ", "lang", "source").alias("prompt"))
    return complete(rows, "prompt", stubs.length_model()).select("doc_id", "prompt", "reply", "reply_error")


def extend_gold(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    gold = turns.where(F.col("turn") == 0).select(F.col("text").alias("question"), F.lit(True).alias("verified"))
    confirmed = turns.select(F.col("text").alias("question"), F.lit(True).alias("verified"))
    return review.extend_gold(gold, confirmed)


def extend_training(spark, sf_dir):
    """Half the parts are training records; lines are reviews of receipts, some confirmed, some without text."""
    part = table(spark, sf_dir, "part")
    records = part.where(F.col("p_partkey") % 2 == 0).select(
        F.concat(F.lit("receipt "), "p_partkey").alias("input"), F.to_json(F.struct(F.col("p_name").alias("company"))).alias("output")
    )
    def fields(total: Column) -> Column:
        return F.struct(F.concat(F.lit("shop "), F.col("l_suppkey")).alias("company"), total.alias("total"))

    reviews = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.concat(F.lit("receipt "), "l_partkey")).alias("receipt_text"),
        fields(F.lit("?")).alias("predicted"),
        F.when(F.col("l_returnflag") != "N", fields(F.col("l_quantity").cast("bigint").cast("string"))).alias("corrected"),
        F.when(F.col("l_linenumber") > 1, F.trunc("l_shipdate", "month")).alias("version"),
    )
    return review.extend_training(records, reviews)


# Mail


def mail_clean(spark, sf_dir):
    messages = documents(spark, sf_dir).select("doc_id", F.col("text").alias("message"))
    return mail.clean_mail(messages, ["doc_id"], max_samples=500).select("doc_id", "email_text")


def mail_body(spark, sf_dir):
    message = F.concat(F.lit("role: "), "role", F.lit("\n\n"), "text", F.lit("  \n"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.mail_body(message).alias("body"))


def pii_scan(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.col("text").alias("email_text"))
    return mail.scan_mail(rows, COMPANY).select("doc_id", "pii_found", "privacy_scan", "contextual_text")


def pii_redact(spark, sf_dir):
    rows = mail.redact_mail(documents(spark, sf_dir).select("doc_id", F.col("text").alias("email_text")))
    shown = F.transform("placeholders", lambda p: F.concat_ws("=", p["placeholder"], p["value"]))
    return rows.select("doc_id", "redacted", F.array_join(shown, ";").alias("placeholders"))


def pii_redact_kinds(spark, sf_dir):
    """Addresses, phone and card numbers by pattern, callers by a recogniser, and the text put back."""
    rows = documents(spark, sf_dir).select(F.col("doc_id").alias("mail_id"), F.col("text").alias("email_text"))
    found = mail.redact_mail(rows, patterns=privacy.PATTERNS, recogniser=stubs.caller_recogniser())
    shown = F.transform("placeholders", lambda p: F.concat_ws("=", p["placeholder"], p["value"]))
    back = privacy.restored("redacted", "placeholders")
    return found.select("mail_id", "redacted", F.array_join(shown, ";").alias("placeholders"), back.alias("restored"))


def rehydrate(spark, sf_dir):
    """The redacted text as the draft: putting the values back must give the text."""
    rows = mail.redact_mail(documents(spark, sf_dir).select(F.col("doc_id").alias("mail_id"), F.col("text").alias("email_text")))
    drafts = rows.select("mail_id", F.col("redacted").alias("response"))
    return mail.rehydrate(drafts, rows.select("mail_id", "placeholders"))


def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def triage_user_turns(spark, sf_dir):
    inbound = _turns(spark, sf_dir).where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("email_text"))
    return jobs.triage(inbound, stubs.mail_model(), COMPANY).drop("email_text")


def _review_events(spark, sf_dir):
    """Assistant turns are drafts (every fourth turn starts afresh), later user turns decisions."""
    draft = F.col("role") == "assistant"
    return _turns(spark, sf_dir).select(
        F.col("conv_id").alias("mail_id"), F.col("turn").alias("seq"),
        F.when(draft & (F.col("turn") % 4 != 1), F.concat(F.lit("redo "), F.col("turn"))).otherwise("").alias("feedback"),
        F.when(draft, F.col("text")).alias("response"),
        F.when((F.col("role") == "user") & (F.col("turn") > 1), F.length("text") % 2 == 0).alias("approved"),
    )


def review_fold(spark, sf_dir):
    return mail.fold_reviews(_review_events(spark, sf_dir))


def approval_map(spark, sf_dir):
    return _turns(spark, sf_dir).select(
        "conv_id", "turn", routing.approval(F.length("text") % 2 == 0).alias("a")
    ).select("conv_id", "turn", "a.status", "a.action")


def customer_lookup(spark, sf_dir):
    """Orders as mail; half the addresses are unknown, and overdrawn customers have two records."""
    inbound = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("c"), F.col("o_custkey") * 2, F.lit("@example.com")).alias("email")
    )
    customer = table(spark, sf_dir, "customer")
    address = F.concat(F.lit("c"), F.col("c_custkey"), F.lit("@example.com")).alias("email")
    now = customer.select(address, F.col("c_name").alias("name"), F.col("c_mktsegment").alias("tier"))
    old = customer.where(F.col("c_acctbal") < 0).select(
        address, F.concat(F.lit("A former "), F.col("c_name")).alias("name"), F.lit("NONE").alias("tier")
    )
    return mail.with_customer(inbound, now.unionByName(old), order=["name"]).select("o_orderkey", "email", "name", "tier")


def classification_parse(spark, sf_dir):
    kind = F.col("event_id") % 5
    reply = (
        F.when(kind == 0, F.concat(F.lit('{"priority": "'), "event_type", F.lit('", "type": "info"}')))
        .when(kind == 1, F.concat(F.lit('{"priority": "'), "event_type", F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('{"priority": "", "type": "'), "event_type", F.lit('"}')))
        .when(kind == 3, F.concat(F.lit('{"priority": "low", "type": "info"} '), "event_type"))
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select("event_id", parsing.classification(reply).alias("c")).select(
        "event_id", "c.priority", "c.type"
    )


# Review and logs


def feedback_append(spark, sf_dir):
    rows = _turns(spark, sf_dir).where(F.col("role") == "assistant").select(
        F.concat_ws("/", "conv_id", "turn").alias("question"), F.col("text").alias("answer"),
        F.when(F.col("turn") > 3, "missing_source").otherwise("bad_answer").alias("reason"),
    )
    return review.feedback_rows(rows)


def _log(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("prompt_version"), F.col("value").alias("latency"), F.to_date("ts").alias("on_day"),
        k.alias("tokens_in"), (k * 3).alias("tokens_out"), (F.col("value") > 20).alias("error"),
    )


def _stats(stats):
    return stats.select(
        "prompt_version", "calls", _nine("avg_latency").alias("avg_latency"), "max_latency", _nine("p95_latency").alias("p95_latency"),
        "tokens_in", "tokens_out", _nine("cost").alias("cost"), _nine("error_rate").alias("error_rate"),
    )


def call_stats(spark, sf_dir):
    return _stats(calls.call_stats(_log(spark, sf_dir)))


def call_stats_by_day(spark, sf_dir):
    """Days rolled up apart, then merged."""
    return _stats(calls.merge_call_days(calls.call_days(_log(spark, sf_dir), "on_day")))


def review_queue(spark, sf_dir):
    flagged = _scored(spark, sf_dir).where("flagged")
    links = layout.link_boxes(_tokens(spark, sf_dir, F.col("l_orderkey"))).where(F.col("confidence") < routing.FIELD_CONFIDENCE)
    drafts = _turns(spark, sf_dir).where(F.col("role") == "assistant")
    asked = feedback_append(spark, sf_dir)
    return review.review_queue(
        review.queue_item(flagged, "answer", F.col("doc_id"), F.lit("low score"), _nine("average")),
        review.queue_item(links, "field", F.concat_ws(":", "doc_id", "question_pos"), F.lit("low confidence"), F.col("confidence")),
        review.queue_item(drafts, "draft", F.concat_ws(":", "conv_id", "turn"), F.lit("approval")),
        review.queue_item(asked, "feedback", F.col("question"), F.col("reason")),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        chunk_documents, chunk_manifest, vector_topk, vector_topk_filtered, vector_topk_cells, vector_neighbours, rag_context,
        ingest_new_only, cached_answers, cached_answers_cells, cache_misses, rerank, source_cards, score_parse, evaluate_rows,
        evaluate_summary, judge_alignment, context_precision, target_check, score_bands, field_scores,
        exact_match_rate, box_links, box_links_large, box_links_wide, document_clearance, clearance_records, redaction_boxes,
        confidence_route, pair_by_stem, normalise_receipts, training_text, ordered_split, line_index, extract_fallback_stub,
        field_json, head_per_group, corpus_sample, qa_sources, generate_qa_stub, cap_pairs, complete_stub,
        extend_gold, extend_training, mail_clean, mail_body, pii_scan, pii_redact, pii_redact_kinds, rehydrate, triage_user_turns, review_fold,
        approval_map, customer_lookup, classification_parse, feedback_append, call_stats, call_stats_by_day, review_queue,
    )
}
