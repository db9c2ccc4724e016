import random
import re

import pytest
from pyspark.sql import functions as F

from docsift.functions import parsing as ps
from docsift.functions import privacy as pv
from docsift.functions import prompts, routing
from docsift.operators import mail as ml


def test_object_text(one):
    texts = ['a {"k": {"x": 1}} b', "none", "} {", "{", "x}", "", None]
    assert one(texts, ps.object_text) == ['{"k": {"x": 1}}', None, None, None, None, None, None]


def test_classification(one):
    texts = [
        '{"priority": "urgent", "type": "complaint"}', '{"priority": "", "type": "odd"}', '{"type": null}',
        '{"priority": "low", "type": "info"} thanks', '[{"priority": "low"}]', '{"priority": "low", "typ', "text", "", None,
    ]
    d = ps.NO_LABEL
    got = [(r["priority"], r["type"]) for r in one(texts, ps.classification)]
    assert got == [("urgent", "complaint"), (d, "odd"), (d, d), (d, d), (d, d), (d, d), (d, d), (d, d), (d, d)]


def test_question_answer_pairs(one):
    texts = ['[{"question": "q", "answer": "a"}, {"question": "r"}]', '{"question": "q"}', "[bad", '[] tail', "[]", None]
    got = [[(p["question"], p["answer"]) for p in r] for r in one(texts, ps.question_answer_pairs)]
    assert got == [[("q", "a"), ("r", None)], [], [], [], [], []]


def test_receipt_struct_tells_missing_from_null(one):
    got = one(['{"company": null, "date": "d", "total": 5}'], lambda c: ps.receipt_struct(ps.json_fields(c)))[0]
    assert tuple(got) == ("None", "d", "", "5")


def test_pii_scan(one):
    texts = ["1234-555-123-45678", "a@b", "x@y.-", "٠١٢-٣٤٥-٦٧٨٩", "#ORD-4821", "mail bob@example.com now", "", None]
    assert one(texts, pv.has_pii) == [True, False, True, True, False, True, False, False]


def test_redaction_numbers_values(one):
    got = one(["a@b.co, 555-123-4567, a@b.co and xa@b.co.uk"], pv.redaction)[0]
    assert got.redacted == "[EMAIL_1], [PHONE_2], [EMAIL_1] and [EMAIL_3]"
    assert [tuple(p) for p in got.placeholders] == [
        ("[EMAIL_1]", "a@b.co"), ("[PHONE_2]", "555-123-4567"), ("[EMAIL_3]", "xa@b.co.uk"),
    ]
    taken = one(["[EMAIL_1] wrote to a@b.co"], pv.redaction)[0]
    assert taken.redacted == "[EMAIL_1] wrote to [EMAIL_2]"


def test_rehydrate_gives_the_text_back(spark):
    rng = random.Random(5)
    bits = ["a@b.co", "xa@b.co", "555-123-4567", "[EMAIL_1]", "[PHONE_3]", "x", "\n", " ", "[", "]", "ü"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(200)]
    rows = ml.redact_mail(spark.createDataFrame(list(enumerate(texts)), "mail_id int, email_text string"))
    drafts = rows.select("mail_id", F.col("redacted").alias("response"))
    back = {r.mail_id: r.response for r in ml.rehydrate(drafts, rows).collect()}
    assert [back[i] for i in range(len(texts))] == texts
    either = re.compile(f"{pv.EMAIL_PATTERN}|" + r"\d{3}-\d{3}-\d{4}")
    leaks = [r.redacted for r in rows.collect() if either.search(r.redacted)]
    assert leaks == []


def test_routing(spark):
    df = spark.createDataFrame([(0.96, True), (0.95, False), (None, False)], "s double, ok boolean")
    got = df.select(routing.confidence_route("s").alias("r"), routing.approval("ok").alias("a")).collect()
    assert [r.r for r in got] == ["auto", "review", "review"]
    assert [tuple(r.a) for r in got] == [("approved", "email_sent")] + [("rejected", "archived_for_review")] * 2


def test_prompts_hold_their_slots(spark):
    df = spark.createDataFrame([("why 100%?", "{ctx} %s")], "q string, c string")
    p = df.select(
        prompts.answer_prompt("q", "c").alias("answer"), prompts.reply_prompt("q", "c").alias("reply"),
        prompts.revise_prompt("q", "c", "q").alias("revise"), prompts.classify_prompt("q").alias("sort"),
        prompts.receipt_prompt("c").alias("receipt"), prompts.qa_prompt("c", 4).alias("qa"),
    ).first()
    for name in ("answer", "reply", "revise"):
        assert "why 100%?" in p[name] and "{ctx} %s" in p[name]
    assert "cite" in p.answer and "urgent" in p.sort and "complaint" in p.sort
    assert "{ctx} %s" in p.receipt and "{ctx} %s" in p.qa and "4" in p.qa
    long = spark.createDataFrame([("c" * 4000, "a" * 2000)], "c string, a string")
    f = long.select(prompts.faithfulness_prompt("a", "c", prompts.ANSWER_CHARS, prompts.CONTEXT_CHARS)).first()[0]
    assert f.count("c" * 3000) == 1 and "c" * 3001 not in f and "a" * 1501 not in f


def test_spans_are_leftmost_then_longest():
    spans = [("A", 5, 9), ("B", 0, 3), ("C", 2, 8), ("D", 5, 12), ("E", 12, 13), ("F", 12, 13)]
    assert pv.chosen_spans(spans) == [("B", 0, 3), ("D", 5, 12), ("E", 12, 13)]


def test_redaction_of_any_kinds(spark):
    texts = [
        "Ann Lee: a@b.cd, 4111 1111 1111 1111 or 4111-1111-1111-1111; again a@b.cd, [CARD_7]", None, "", "nothing",
        "123-456-7890@x.yz and 123-456-7890", "Ann [NAME_3] Lee " + "9@a.bc " * 3000, "\U0001f600 Ann Lee \u0663\u0663\u0663-456-7890",
    ]

    def names(batch):
        import re

        return [[("NAME", m.start(), m.end()) for m in re.finditer("Ann Lee|Ann", t)] for t in batch]

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.withColumn("r", pv.redaction_of_kinds("t", pv.PATTERNS, names))
    rows = {r.i: r for r in found.select("i", "t", "r.*", pv.restored("r.redacted", "r.placeholders").alias("back")).collect()}
    assert all(r.back == r.t for r in rows.values())
    assert rows[0].redacted == "[NAME_8]: [EMAIL_9], [CARD_10] or [CARD_11]; again [EMAIL_9], [CARD_7]"
    assert rows[4].redacted == "[EMAIL_1] and [PHONE_2]" and rows[1].redacted is None and rows[2].redacted == ""
    assert rows[5].redacted.startswith("[NAME_4] [NAME_3] Lee [EMAIL_5] ") and len(rows[5].placeholders) == 2
    assert rows[6].redacted == "\U0001f600 [NAME_1] [PHONE_2]"
    with pytest.raises(ValueError):
        pv.redaction_of_kinds("t", {"no good": "x"})
    with pytest.raises(Exception, match="outside the text"):
        df.select(pv.redaction_of_kinds("t", {}, lambda batch: [[("NAME", 0, 10**6)] for _ in batch])).collect()
