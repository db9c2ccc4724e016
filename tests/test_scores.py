import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.functions import scores as sc
from docsift.operators import extraction, judge


def test_score_from_reply(one):
    cases = {
        "0.85": 0.85, "Score: 0.9/1": 0.9, "8.0": 0.0, "1.5": 1.0, "1.00": 1.0, "-0.3": 0.3,
        "10": 0.5, ".85": 0.5, "95%": 0.5, "": 0.5, "é1": 0.5, "it is 1": 1.0,
    }
    assert one([*cases, None], sc.score_from_reply) == [*cases.values(), 0.5]


def rule(p, t):
    p, t = p.strip().lower(), t.strip().lower()
    if not t:
        return 0.0 if p else 1.0
    if p == t:
        return 1.0
    return 0.5 if p in t or t in p else 0.0


def test_field_score(spark):
    values = ["", "a", "A ", " ab　", "b", "AB c", "%"]
    pairs = list(itertools.product(values, values))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p string, t string")
    got = [r[0] for r in df.orderBy("i").select(sc.field_score("p", "t")).collect()]
    assert got == [rule(p, t) for p, t in pairs]
    nulls = spark.createDataFrame([(None, "x"), ("x", None), (None, None)], "p string, t string")
    assert [r[0] for r in nulls.select(sc.field_score("p", "t")).collect()] == [0.5, 0.0, 1.0]


def fields(*values):
    return dict(zip(sc.RECEIPT_FIELDS, values))


@pytest.mark.parametrize(
    "pred,gold,macro,exact",
    [
        (fields("Shop", "1.1.", "Rd 1", "5.00"), fields("shop ", "1.1.", "RD 1", "5.00"), 1.0, True),
        (fields("q", "q", "q", "q"), fields("Shop", "1.1.", "Rd 1", "5.00"), 0.0, False),
        (fields("Shop", "1.1.", "Rd 1", "9"), fields("Shop", "1.1.", "Rd 1", "5.00"), 0.75, False),
    ],
)
def test_receipts(spark, pred, gold, macro, exact):
    schema = "receipt_id string, fields struct<company:string,date:string,address:string,total:string>"
    p = spark.createDataFrame([("r", pred)], schema)
    g = spark.createDataFrame([("r", gold), ("missing", gold)], schema)
    rows = {r.receipt_id: r for r in extraction.score_extractions(p, g).collect()}
    assert (rows["r"].macro_f1, rows["r"].exact_match) == (macro, exact)
    assert (rows["missing"].macro_f1, rows["missing"].exact_match) == (0.5, False)
    total = extraction.extraction_summary(extraction.score_extractions(p, g)).first()
    assert total.n_receipts == 2 and total.field_f1 == (macro + 0.5) / 2


def test_bands_and_percent(one):
    values = [0.85, 0.8499, 0.7, 0.69, 0.0, 1.0]
    assert one(values, sc.score_band, "double") == ["low", "normal", "normal", "urgent", "urgent", "low"]
    assert one([0.8462, 0.0625, 1.0, 0.0], sc.percent_text, "double") == ["84.6%", "6.3%", "100.0%", "0.0%"]


def test_flag_is_on_the_unrounded_mean(spark):
    rows = [(0, 0.5999, 0.5999, 0.5999), (1, 0.6, 0.6, 0.6000001), (2, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, faithfulness double, relevancy double, correctness double")
    flagged = judge.flag_low(df)
    got = {r.id: r for r in flagged.collect()}
    assert got[0].flagged and not got[1].flagged
    shown = judge.evaluation_rows(
        flagged.withColumns({c: F.lit("") for c in ("question", "ground_truth", "rag_answer")})
    ).where("id = 0").first()
    assert shown.scores.average == 0.6 and shown.flagged
    total = judge.summarise(flagged).first()
    assert (total.total_questions, total.flagged_count, total.flag_rate) == (3, 1, 0.333)
    empty = judge.summarise(flagged.where("false")).first()
    assert (empty.total_questions, empty.avg_faithfulness, empty.flagged_count, empty.flag_rate) == (0, None, 0, 0.0)


@pytest.mark.parametrize("kinds", [(1000, 1000), (4, 3), (1000, 2), (1, 5)])
def test_rank_agreement_against_all_pairs(spark, kinds):
    rng = random.Random(str(kinds))
    rows = [(i, rng.randrange(kinds[0]) / 7, float(rng.randrange(kinds[1]))) for i in range(250)]
    scored = spark.createDataFrame([(i, s) for i, s, _ in rows] + [(900, None)], "doc long, s double")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(900, 1.0)], "doc long, x double")
    agree = sum((a[1] - b[1]) * (a[2] - b[2]) > 0 for a, b in itertools.combinations(rows, 2))
    against = sum((a[1] - b[1]) * (a[2] - b[2]) < 0 for a, b in itertools.combinations(rows, 2))
    apart = [sum(a[k] != b[k] for a, b in itertools.combinations(rows, 2)) for k in (1, 2)]

    def ranks(k):
        order = sorted(r[k] for r in rows)
        return [order.index(r[k]) + (order.count(r[k]) - 1) / 2 for r in rows]

    for cut in (1000, 40):
        row = judge.judge_alignment(scored, labels, "doc", "s", "x", range_rows=cut).first()
        assert row.n_pairs == 251
        if kinds[0] == 1:
            assert row.kendall is None and row.spearman is None
        else:
            assert row.kendall == pytest.approx((agree - against) / (apart[0] * apart[1]) ** 0.5)
            assert row.spearman == pytest.approx(float(np.corrcoef(ranks(1), ranks(2))[0, 1]))
    none = judge.judge_alignment(scored.where("false"), labels, "doc", "s", "x").first()
    assert (none.n_pairs, none.kendall, none.spearman, none.correlation) == (0, None, None, None)
