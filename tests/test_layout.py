import random

import pytest

from docsift.operators import layout
from docsift.plans import jobs

SCHEMA = "doc_id string, token_pos int, text string, label string, box array<int>, confidence double"
FORM = [
    ("f", 0, "Full Name:", "QUESTION", [50, 50, 180, 80], 0.99),
    ("f", 1, "Jane Doe", "ANSWER", [190, 50, 350, 80], 0.96),
    ("f", 2, "Social Security Number:", "QUESTION", [50, 100, 250, 130], 0.98),
    ("f", 3, "***-**-1234", "ANSWER", [260, 100, 400, 130], 0.81),
    ("f", 4, "Date of Birth:", "QUESTION", [50, 150, 180, 180], 0.97),
    ("f", 5, "01/01/1990", "ANSWER", [190, 150, 320, 180], 0.94),
]


def test_form(spark):
    tokens = spark.createDataFrame(FORM, SCHEMA)
    links = layout.link_boxes(tokens)
    got = {r.question: (r.answer, round(r.distance, 1)) for r in links.collect()}
    assert got == {
        "Full Name:": ("Jane Doe", 155.0), "Social Security Number:": ("01/01/1990", 116.3), "Date of Birth:": ("01/01/1990", 140.0),
    }
    (record,) = jobs.clear(tokens).collect()
    assert record.document_status == "CLEARED"
    assert [tuple(f) for f in record.extracted_fields] == [
        ("Full Name:", "[REDACTED]", 0.96, "PROCESSED"), ("Social Security Number:", "[REDACTED]", 0.94, "PROCESSED"),
        ("Date of Birth:", "[REDACTED]", 0.94, "PROCESSED"),
    ]
    assert layout.redaction_boxes(tokens, links).count() == 2
    assert layout.redaction_boxes(tokens, links, require_all_answers_masked=True).count() == 3


def test_review_and_documents_without_links(spark):
    rows = [
        ("low", 0, "q", "QUESTION", [0, 0, 2, 2], 0.9), ("low", 1, "a", "ANSWER", [0, 0, 2, 2], 0.84),
        ("no answer", 0, "q", "QUESTION", [0, 0, 2, 2], 0.9), ("no question", 0, "a", "ANSWER", [0, 0, 2, 2], 0.1),
    ]
    tokens = spark.createDataFrame(rows, SCHEMA)
    status = {r.doc_id: r.document_status for r in layout.clear_documents(tokens, layout.link_boxes(tokens)).collect()}
    assert status == {"low": "MANUAL_REVIEW_REQUIRED", "no answer": "CLEARED", "no question": "CLEARED"}
    records = {r.doc_id: r for r in jobs.clear(tokens).collect()}
    assert records["low"].extracted_fields[0].status == "FLAGGED_FOR_REVIEW"
    assert records["no answer"].extracted_fields == []


def test_ties_go_to_the_first_answer(spark):
    rows = [("d", 9, "q", "QUESTION", [10, 10, 10, 10], 1.0)]
    rows += [("d", i, f"a{i}", "ANSWER", [10 + dx, 10 + dy] * 2, 1.0) for i, (dx, dy) in enumerate([(9, 0), (0, 5), (5, 0), (0, -5), (3, 4), (3, 4)])]
    tokens = spark.createDataFrame(rows, SCHEMA)
    for small in (0, 100):
        assert [(r.answer, r.distance) for r in layout.link_boxes(tokens, small).collect()] == [("a1", 5.0)]


def brute(rows):
    out = {}
    for q in rows:
        if q[3] != "QUESTION":
            continue
        best = None
        for a in sorted((r for r in rows if r[3] == "ANSWER" and r[0] == q[0]), key=lambda r: r[1]):
            dx = (q[4][0] + q[4][2]) - (a[4][0] + a[4][2])
            dy = (q[4][1] + q[4][3]) - (a[4][1] + a[4][3])
            if best is None or dx * dx + dy * dy < best[0]:
                best = (dx * dx + dy * dy, a[1])
        if best:
            out[(q[0], q[1])] = best[1]
    return out


@pytest.mark.parametrize("shape", ["even", "apart", "negative", "wide"])
def test_both_plans_agree_with_brute_force(spark, monkeypatch, shape):
    rng = random.Random(shape)
    rows = []
    for i in range(600):
        doc = "hot" if rng.random() < 0.5 else f"d{rng.randrange(30)}"
        label = rng.choice(["QUESTION", "ANSWER", "OTHER"])
        span = {"even": 300, "apart": 40, "negative": 500, "wide": 200_000}[shape]
        x, y = rng.randrange(span), rng.randrange(span)
        if shape == "apart" and label == "ANSWER":
            x += 5000
        if shape == "negative":
            x, y = x - 250, y - 400
        rows.append((doc, i, f"t{i}", label, [x, y, x + rng.randrange(9), y + rng.randrange(9)], 0.9))
    tokens = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    for small, sent in ((0, layout.BROADCAST_CHILDREN), (0, 0), (5, 0), (1000, 0)):
        monkeypatch.setattr(layout, "BROADCAST_CHILDREN", sent)
        got = {(r.doc_id, r.question_pos): r.answer_pos for r in layout.link_boxes(tokens, small).collect()}
        assert got == want


def test_boxes_without_a_centre_neither_ask_nor_answer(spark):
    bad = [None, [], [1, 2, 3], [1, None, 3, 4]]
    rows = [("d", i, "a", "ANSWER", b, 0.9) for i, b in enumerate(bad)] + [("d", 10 + i, "q", "QUESTION", b, 0.9) for i, b in enumerate(bad)]
    rows += [("d", 20, "a", "ANSWER", [50, 50, 60, 60], 0.9), ("d", 21, "a", "ANSWER", [90, 50, 90, 60], 0.9), ("d", 22, "q", "QUESTION", [0, 0, 2, 2], 0.9)]
    tokens = spark.createDataFrame(rows, SCHEMA)
    for small in (0, 1, 100):
        assert [(r.question_pos, r.answer_pos) for r in layout.link_boxes(tokens, small).collect()] == [(22, 20)]
        none = spark.createDataFrame(rows[:8], SCHEMA)
        assert layout.link_boxes(none, small).count() == 0


def test_the_tree_follows_the_extent_and_skips_levels(spark):
    """Two far corners of a wide page: the levels between them have nothing to tell apart."""
    rng = random.Random(8)
    at = {(base + rng.randrange(30), base + rng.randrange(30)) for base in (0, 2**26) for _ in range(80)}
    points = spark.createDataFrame([("far", x, y) for x, y in at] + [("one", 5, 5)], "doc_id string, x long, y long")
    nodes, heights, held = layout._tree(points)
    kept = {r.doc_id: r.kept for r in heights.collect()}
    assert len(kept["far"]) <= 4 and kept["one"] == [0, 1] and max(held) == len(kept["far"]) - 1
    assert max(len(r.children) for r in nodes.collect()) <= 64


def test_long_documents_come_in_parts(spark):
    n = 25
    rows = [("long", i, f"q{i:02d}", "QUESTION", [i, 0, i, 0], 0.9) for i in range(n)] + [("long", n, "a", "ANSWER", [0, 0, 0, 0], 0.5)]
    rows += [("short", 0, "q", "QUESTION", [0, 0, 0, 0], 0.9), ("short", 1, "a", "ANSWER", [0, 0, 0, 0], 0.9)]
    tokens = spark.createDataFrame(rows, SCHEMA)
    parts = layout.clearance_records(tokens, layout.link_boxes(tokens), fields_per_part=10).orderBy("doc_id", "part").collect()
    assert [(p.doc_id, p.part, len(p.extracted_fields)) for p in parts] == [("long", 0, 10), ("long", 1, 10), ("long", 2, 5), ("short", 0, 1)]
    assert [f.field_name for p in parts[:3] for f in p.extracted_fields] == [f"q{i:02d}" for i in range(n)]
    assert {p.document_status for p in parts[:3]} == {"MANUAL_REVIEW_REQUIRED"}
