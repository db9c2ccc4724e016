import json
import math
import random

import pytest
from pyspark.sql import functions as F

from docsift.operators import calls, context, mail
from docsift.plans import jobs
from docsift.sources.readers import read_vectors


def test_ingest_and_answer(spark, tmp_path):
    path = str(tmp_path / "vectors")
    docs = spark.createDataFrame([("refunds are paid within thirty days", "refund.txt"), ("the office opens at nine every day", "office.txt"), ("tiny", "t.txt")], "text string, source string")
    assert tuple(jobs.ingest(docs, path).first()) == (3, 2)
    jobs.ingest(docs, path)
    vectors = read_vectors(spark, path)
    assert vectors.count() == 2
    questions = spark.createDataFrame([(1, "refunds paid within how many days"), (2, "")], "question_id int, question string")
    rows = {r.question_id: r for r in jobs.answer(questions, vectors, lambda ps, t: [f"{t} {'refunds are' in p}" for p in ps], k=1).collect()}
    assert rows[1].retrieved_context == "[1] refunds are paid within thirty days" and rows[1].answer == "0.2 True"
    (source,) = rows[1].sources
    assert (source.chunk_id, source.metadata.source, source.metadata.chunk_index) == (1, "refund.txt", 0)
    # no hits: an empty context, and an answer all the same
    assert (rows[2].retrieved_context, rows[2].chunks_used, rows[2].sources, rows[2].answer) == ("", 0, [], "0.2 False")


def test_context_order(spark):
    q = spark.createDataFrame([("q",)], "question_id string")
    hits = spark.createDataFrame([("q", i, f"t{i}", i / 10) for i in (3, 1, 2, 11)], "question_id string, rank int, text string, distance double")
    row = context.build_context(q, hits).first()
    assert row.retrieved_context == "[1] t1\n\n[2] t2\n\n[3] t3\n\n[11] t11" and row.chunks_used == 4


def test_source_cards(spark):
    df = spark.createDataFrame([("s", "", "sec", "x" * 151), (None, "3", "sec", "x" * 150), ("", None, None, None)], "source string, page string, section string, content string")
    cols = [F.col(c) for c in df.columns]
    got = [tuple(r) for r in df.select(context.source_card(*cols, chars=150).alias("c")).select("c.*").collect()]
    assert got == [("s", "sec", "x" * 150 + "..."), ("Unknown", "3", "x" * 150), ("Unknown", "N/A", "")]


def test_evaluate(spark, tmp_path):
    qa = spark.createDataFrame([(0, "q0", "t0"), (1, "q1", "t1"), (2, "q2", "t2")], "id long, question string, ground_truth string")
    answers = spark.createDataFrame([("q0", "good", "ctx"), ("q1", "poor", "ctx")], "question string, answer string, retrieved_context string")

    def fn(prompts, temperature):
        return ["0.9" if "good" in p else "0.3" for p in prompts]

    path = str(tmp_path / "runs")
    rows, summary = jobs.evaluate(qa, answers, fn, path=path, run_id="r1", run_time="2024-01-02 03:04:05")
    assert {r.id: r.flagged for r in rows.collect()} == {0: False, 1: True, 2: True}
    s = summary.first()
    assert (s.total_questions, s.avg_faithfulness, s.avg_relevancy, s.flagged_count, s.flag_rate) == (3, 0.4, 0.5, 2, 0.667)
    jobs.evaluate(qa, answers, fn, path=path, run_id="r2", run_time="2024-01-03 00:00:00")
    assert spark.read.parquet(path + "/aggregate").where("run_id = 'r1'").first().flag_rate == 0.667
    stored = spark.read.parquet(path + "/results")
    assert {r.run_id: r["count"] for r in stored.groupBy("run_id").count().collect()} == {"r1": 3, "r2": 3}
    assert stored.first().config == {"flag_threshold": "0.6"}
    with pytest.raises(ValueError):
        jobs.evaluate(qa, answers, fn, path=path)


def test_build_qa_set(spark, tmp_path):
    df = spark.createDataFrame([("f", i, "x" * 101) for i in range(30)], "file string, pos int, text string")
    out = str(tmp_path / "qa")
    pairs = jobs.build_qa_set(df, lambda ps, t: ['[{"question": "q", "answer": "a"}]' for _ in ps], out, per_file=20)
    assert pairs.count() == 20
    whole = jobs.build_qa_set(df, lambda ps, t: ['[{"question": "q", "answer": "a"}]' for _ in ps])
    assert whole.count() == 30
    saved = [json.loads(line) for p in (tmp_path / "qa").glob("*.json") for line in p.read_text().splitlines()]
    assert saved == [{"question": "q", "answer": "a", "verified": False}] * 20


def test_triage(spark, tmp_path):
    df = spark.createDataFrame([(1, "I am angry, call 555-123-4567")], "mail_id long, email_text string")
    folder = str(tmp_path)

    def fn(prompts, temperature):
        import os

        for p in prompts:
            with open(os.path.join(folder, str(len(os.listdir(folder)))), "w") as f:
                f.write(p)
        return ['{"priority": "urgent", "type": "complaint"}' if p.startswith("Sort") else f"draft at {temperature}" for p in prompts]

    row = jobs.triage(df, fn, "notes, mail us at desk@example.com").first()
    assert (row.priority, row.type, row.response) == ("urgent", "complaint", "draft at 0.3")
    assert row.privacy_scan == "FLAGGED (Contains PII)" and row.requires_approval is True
    prompts = sorted(p.read_text() for p in tmp_path.iterdir())
    assert len(prompts) == 2 and all("555-123-4567" in p and "desk@example.com" in p for p in prompts)
    assert "urgent" in prompts[0] and "complaint" in prompts[0]
    clean = spark.createDataFrame([(1, "order #ORD-4821")], "mail_id long, email_text string")
    assert mail.scan_mail(clean, "desk@example.com").first().privacy_scan == "PASSED"


def test_revise_and_fold(spark):
    drafts = spark.createDataFrame([(1, "mail", "old", "shorter", 0), (2, "mail", "old", "", 3)], "mail_id int, email_text string, response string, feedback string, revision_count int")
    rows = {r.mail_id: (r.response, r.revision_count) for r in jobs.revise(drafts, lambda ps, t: ["new"] * len(ps)).collect()}
    assert rows == {1: ("new", 1), 2: ("old", 3)}
    events = [
        (1, 0, "", "d0", None), (1, 1, "more", "d1", None), (1, 2, "less", "d2", None), (1, 3, None, None, True),
        (2, 0, None, "d0", None), (2, 1, "x", "d1", None), (2, 2, "", "d2", None), (2, 3, "y", "d3", None), (2, 4, None, None, True), (2, 5, None, None, False),
        (3, 0, None, None, False), (4, 0, "x", "only revision", None),
    ]
    df = spark.createDataFrame(events, "mail_id int, seq int, feedback string, response string, approved boolean")
    got = {r.mail_id: (r.revision_count, r.response, r.approved) for r in mail.fold_reviews(df).collect()}
    assert got == {1: (2, "d2", True), 2: (1, "d3", False), 3: (0, None, False), 4: (1, "only revision", None)}


def test_customers(spark):
    inbound = spark.createDataFrame([(i, "a@x") for i in range(50)] + [(50, "b@x"), (51, None)], "mail_id int, email string")
    people = spark.createDataFrame([("a@x", "Zoe", "gold", "2024-01-01"), ("a@x", "Ann", "free", None)], "email string, name string, tier string, last_order string")
    rows = mail.with_customer(inbound, people).collect()
    assert len(rows) == 52 and {r.name for r in rows if r.email == "a@x"} == {"Ann"} and sum(r.name is None for r in rows) == 2


def test_call_stats(spark):
    log = spark.createDataFrame([("v1", 1.0, 1_000_000, 250_000, False), ("v1", 3.0, 0, 0, True)], "prompt_version string, latency double, tokens_in long, tokens_out long, error boolean")
    row = calls.call_stats(log).first()
    assert (row.calls, row.avg_latency, row.tokens_in, row.tokens_out, row.error_rate) == (2, 2.0, 1_000_000, 250_000, 0.5)
    assert row.cost == pytest.approx(0.30) and row.p95_latency == pytest.approx(3.0, rel=0.01)


def test_merged_days_equal_one_pass(spark):
    rng = random.Random(6)
    rows = []
    for i in range(3000):
        latency = None if i % 50 == 0 else 0.0 if i % 70 == 0 else round(rng.lognormvariate(1, 1.5), 4)
        rows.append((f"2024-01-{rng.randrange(1, 28):02d}", rng.choice(["v1", "v1", "v2", None]), latency, i, None if i % 9 else 2 * i, rng.random() < 0.1))
    log = spark.createDataFrame(rows, "on_day string, prompt_version string, latency double, tokens_in long, tokens_out long, error boolean")
    days = calls.call_days(log, "on_day")
    whole = {r.prompt_version: r for r in calls.call_stats(log).collect()}
    merged = {r.prompt_version: r for r in calls.merge_call_days(days).collect()}
    assert days.count() > 60 and set(whole) == {"v1", "v2", None}
    for version, row in whole.items():
        assert [merged[version][c] for c in ("calls", "max_latency", "p95_latency", "tokens_in", "tokens_out", "error_rate")] == [
            row[c] for c in ("calls", "max_latency", "p95_latency", "tokens_in", "tokens_out", "error_rate")
        ]
        assert merged[version].avg_latency == pytest.approx(row.avg_latency)
        own = sorted(r[2] for r in rows if r[1] == version and r[2] is not None)
        assert row.p95_latency == pytest.approx(own[math.ceil(0.95 * len(own)) - 1], rel=0.01)
    untimed = calls.call_stats(log.where("latency is null")).where("prompt_version = 'v2'").first()
    assert untimed.p95_latency is None and untimed.avg_latency is None and untimed.calls > 0
    assert calls.call_stats(log.where("false")).count() == 0
