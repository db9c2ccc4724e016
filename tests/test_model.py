import json

import pytest
from pyspark.sql import functions as F

from docsift.operators import extraction, judge, mail
from docsift.operators.model import complete


@pytest.fixture
def calls(spark, tmp_path):
    """A folder the stand-in models note their prompts in, and a reader for it."""

    def noted():
        return [json.loads(p.read_text()) for p in tmp_path.glob("*.json")]

    return str(tmp_path), noted


def noting(folder, answer):
    def fn(prompts, temperature):
        import json
        import os
        import uuid

        for p in prompts:
            with open(os.path.join(folder, uuid.uuid4().hex + ".json"), "w") as f:
                json.dump([p, temperature], f)
        return [answer(p) for p in prompts]

    return fn


def test_equal_prompts_are_sent_once(spark, calls):
    folder, noted = calls
    df = spark.range(500).select("id", F.when(F.col("id") < 400, "same").when(F.col("id") < 499, F.concat(F.lit("p"), F.col("id") % 10)).alias("p"))
    out = complete(df, "p", noting(folder, lambda p: p.upper()), temperature=0.3, keep=True)
    rows = out.collect()
    assert out.where("reply = 'SAME'").count() == 400  # read twice, called once
    assert len(rows) == 500 and all(r.reply == (r.p.upper() if r.p else None) for r in rows)
    assert sorted(noted()) == sorted([[p, 0.3] for p in ["same", *(f"p{i}" for i in range(10))]])


def test_failures(spark):
    df = spark.createDataFrame([("ok",), ("bad",)], "p string")

    def fn(prompts, temperature):
        if "bad" in prompts:
            raise RuntimeError("no reply")
        return prompts

    got = {r.p: (r.reply, r.reply_error) for r in complete(df.coalesce(1), "p", fn, on_error="null", backoff=0, retries=1).collect()}
    assert got == {"ok": ("ok", None), "bad": (None, "no reply")}
    with pytest.raises(Exception, match="no reply"):
        complete(df, "p", fn, backoff=0, retries=0).collect()
    with pytest.raises(Exception, match="one reply per prompt"):
        complete(df, "p", lambda p, t: [], backoff=0, retries=0).collect()


def test_retries(spark, tmp_path):
    folder = str(tmp_path)

    def fn(prompts, temperature):
        import os

        n = len(os.listdir(folder))
        open(os.path.join(folder, str(n)), "w").close()
        if n < 2:
            raise RuntimeError("later")
        return ["done"] * len(prompts)

    df = spark.createDataFrame([("p",)], "p string")
    assert [r.reply for r in complete(df, "p", fn, backoff=0).collect()] == ["done"]


QA = "id long, question string, ground_truth string, rag_answer string, retrieved_context string"


def test_empty_inputs_score_zero_without_a_call(spark, calls):
    folder, noted = calls
    df = spark.createDataFrame([(0, "", "", "", ""), (1, None, "t", "a", None)], QA)
    rows = judge.judge(df, noting(folder, lambda p: "0.9")).orderBy("id").collect()
    assert [(r.faithfulness, r.relevancy, r.correctness) for r in rows] == [(0.0, 0.0, 0.0), (0.0, 0.0, 0.9)]
    assert len(noted()) == 1 and noted()[0][1] == 0.0


def test_failed_answers_are_still_judged(spark):
    qa = spark.createDataFrame([(0, "q0", "t"), (1, "q1", "t"), (2, "q2", "t")], "id long, question string, ground_truth string")
    answers = spark.createDataFrame([("q0", "a", "c", None), ("q1", None, None, "timed out")], "question string, answer string, retrieved_context string, error string")
    paired = judge.attach_answers(qa, answers)
    assert [(r.rag_answer, r.retrieved_context) for r in paired.orderBy("id").collect()] == [("a", "c"), ("ERROR: timed out", ""), ("ERROR: no answer", "")]
    rows = judge.judge(paired, lambda ps, t: ["unreadable" if "ERROR" in p else "0.85" for p in ps]).orderBy("id").collect()
    assert (rows[0].faithfulness, rows[0].relevancy) == (0.85, 0.85)
    assert (rows[1].faithfulness, rows[1].relevancy, rows[1].correctness) == (0.0, 0.5, 0.5)


def test_judge_failures_can_be_kept_as_null(spark):
    df = spark.createDataFrame([(0, "q", "t", "a", "c")], QA)

    def broken(prompts, temperature):
        raise RuntimeError("down")

    row = judge.judge(df, broken, on_error="null", backoff=0, retries=0).first()
    assert (row.faithfulness, row.relevancy, row.correctness) == (None, None, None)


def test_targets_alignment_precision(spark):
    summary = spark.createDataFrame([(0.9, 0.7)], "faithfulness double, correctness double")
    targets = {m: judge.TARGETS[m] for m in ("faithfulness", "correctness")}
    got = {r.metric: r.met for r in judge.check_targets(summary, targets).collect()}
    assert got == {"faithfulness": True, "correctness": False}
    scored = spark.createDataFrame([(1, 0.2), (2, 0.8)], "id int, s double")
    labels = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id int, l double")
    row = judge.judge_alignment(scored, labels, "id", "s", "l").first()
    assert row.n_pairs == 2 and abs(row.correlation - 1) < 1e-12 and abs(row.mean_abs_gap - 0.2) < 1e-12
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c")], "question_id int, rank int, id string")
    relevant = spark.createDataFrame([(1, "a"), (1, "a"), (1, "c")], "question_id int, id string")
    assert judge.context_precision(hits, relevant, 2).first().context_precision == 0.5


def test_extraction_falls_back(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["good", "plain", "broken", "down", "hopeless"])], "i int, receipt_text string")

    def primary(prompts, temperature):
        out = []
        for p in prompts:
            text = p.rpartition("\n")[2]
            if text == "down":
                raise RuntimeError("model down")
            out.append({"good": 'as read: {"company": "Shop"} ok', "plain": "nothing"}.get(text, "{nope}"))
        return out

    def fallback(prompts, temperature):
        return ["none" if p.endswith("hopeless") else '{"company": "B", "total": null}' for p in prompts]

    rows = {r.receipt_text: r for r in extraction.extract(df, primary, fallback, backoff=0, retries=0).collect()}
    assert tuple(rows["good"].fields) == ("Shop", "", "", "") and not rows["good"].requires_review
    assert rows["plain"].fields is None and rows["plain"].raw_output == "nothing" and not rows["plain"].requires_review
    for name in ("broken", "down"):
        assert tuple(rows[name].fields) == ("B", "", "", "None") and rows[name].requires_review and rows[name].model == "api-fallback"
    assert rows["hopeless"].error and rows["hopeless"].raw_output == "none" and rows["hopeless"].requires_review
    alone = {r.receipt_text: r for r in extraction.extract(df, primary, None, backoff=0, retries=0).collect()}
    assert alone["down"].error == "model down" and alone["broken"].requires_review
    nothing = extraction.extract(df).collect()
    assert len(nothing) == 5 and all(r.error and r.requires_review for r in nothing)


def test_generate_qa(spark):
    df = spark.createDataFrame([("f", i, f"text {i}") for i in range(5)], "file string, pos int, text string")

    def fn(prompts, temperature):
        return ["sorry" if p.endswith("text 1") else json.dumps([{"question": p[-6:], "answer": str(i)} for i in range(3)]) for p in prompts]

    rows = extraction.generate_qa(df, fn, ["file", "pos"], target_pairs=7).orderBy("pos", "pair").collect()
    assert [(r.pos, r.pair) for r in rows] == [(0, 0), (0, 1), (0, 2), (2, 0), (2, 1), (2, 2), (3, 0)]
    assert not any(r.verified for r in rows)
    assert extraction.generate_qa(df, fn, ["file", "pos"], target_pairs=None).count() == 12


def test_repeated_keys_keep_one_row_per_left_row(spark):
    qa = spark.createDataFrame([(i, "q", f"t{i}") for i in range(2)] + [(2, None, "t")], "id long, question string, ground_truth string")
    answers = spark.createDataFrame(
        [("q", "b", "c1", None), ("q", "a", "c2", None), ("q", "0", None, "timeout"), (None, "n", "c", None)],
        "question string, answer string, retrieved_context string, error string",
    )
    got = {r.id: (r.rag_answer, r.retrieved_context) for r in judge.attach_answers(qa, answers).collect()}
    assert got == {0: ("a", "c2"), 1: ("a", "c2"), 2: ("ERROR: no answer", "")}
    assert judge.attach_answers(qa, answers).count() == 3
    failed = judge.attach_answers(qa, answers.where("error is not null")).where("id = 0").first()
    assert failed.rag_answer == "ERROR: timeout"
    fields = "struct<company:string,date:string,address:string,total:string>"
    gold = spark.createDataFrame([(1, ("a", "b", "c", "d")), (2, ("x", "", "", ""))], f"receipt_id long, fields {fields}")
    pred = spark.createDataFrame([(1, ("z", "b", "c", "d")), (1, ("a", "b", "c", "d")), (1, ("a", "b", "c", "d"))], f"receipt_id long, fields {fields}")
    scored = {r.receipt_id: r.exact_match for r in extraction.score_extractions(pred, gold).collect()}
    assert scored == {1: True, 2: False} and extraction.score_extractions(pred, gold).count() == 2
    pair = "array<struct<placeholder:string,value:string>>"
    drafts = spark.createDataFrame([(1, "[EMAIL_1] [PHONE_2]"), (1, "[EMAIL_1]")], "mail_id long, response string")
    stored = spark.createDataFrame([(1, [("[EMAIL_1]", "a@b.c")]), (1, [("[EMAIL_1]", "a@b.c"), ("[PHONE_2]", "1")])], f"mail_id long, placeholders {pair}")
    assert sorted(r.response for r in mail.rehydrate(drafts, stored).collect()) == ["a@b.c", "a@b.c 1"]


def test_a_reply_that_most_rows_share(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("p"))
    got = complete(rows.unionByName(rows.limit(5)), "p", lambda p, t: [x + "!" for x in p]).collect()
    assert len(got) == 3005 and all(r.reply == r.p + "!" for r in got)
