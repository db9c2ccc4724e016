import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.functions.embedding import cosine_distance, rounded_distance
from docsift.operators import search
from docsift.operators.embedding import embed

rng = np.random.default_rng(4)
BASE = rng.normal(size=(300, 8))
# Copies make a third of the table equal, one vector has no length, and one is missing.
BASE[:100] = BASE[0]
BASE[150] = 0
ASKED = rng.normal(size=(40, 8))
ASKED[3] = BASE[0]
ASKED[5] = 0


def frames(spark, text_ids=False):
    name = (lambda i: f"id{i:03d}") if text_ids else int
    kind = "string" if text_ids else "long"
    v = spark.createDataFrame([(name(i), [float(x) for x in b], i % 3) for i, b in enumerate(BASE)] + [(name(900), None, 0)], f"id {kind}, embedding array<float>, label int")
    q = spark.createDataFrame([(int(i), [float(x) for x in a]) for i, a in enumerate(ASKED)], "question_id long, embedding array<float>")
    return q.repartition(3), v.repartition(5)


def brute(q, v, k, keep=lambda r: True):
    vs = [(r.id, np.array(r.embedding)) for r in v.collect() if r.embedding and any(r.embedding) and keep(r)]
    out = {}
    for r in q.collect():
        a = np.array(r.embedding)
        if a.any():
            d = sorted((round(1 - float(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), 9) + 0.0, i) for i, b in vs)
            out[r.question_id] = [(i, pytest.approx(x, abs=2e-9)) for x, i in d[:k]]
    return out


def found(hits):
    out = {}
    for r in hits.orderBy("question_id", "rank").collect():
        out.setdefault(r.question_id, []).append((r.id, r.distance))
    return out


@pytest.mark.parametrize("text_ids", [False, True])
@pytest.mark.parametrize("plan", search.PLANS)
def test_plans_agree_with_brute_force(spark, monkeypatch, text_ids, plan):
    q, v = frames(spark, text_ids)
    monkeypatch.setattr(search, "BLOCK_BYTES", 37 * 64)
    monkeypatch.setattr(search, "BLOCK_QUESTIONS", 11)
    assert found(search.vector_search(q, v, 5, plan=plan)) == brute(q, v, 5)


def test_the_plan_follows_the_sizes(spark):
    q, v = frames(spark)
    for small, plan in ((4096, "scan_vectors"), (40, "scan_vectors"), (5, "cells")):
        assert found(search.vector_search(q, v, 3, small_rows=small)) == found(search.vector_search(q, v, 3, plan=plan))
    many = q.withColumn("question_id", F.explode(F.array(*[F.col("question_id") + 1000 * i for i in range(10)])))
    assert found(search.vector_search(many, v, 3, small_rows=310)) == found(search.vector_search(many, v, 3, plan="scan_questions"))
    with pytest.raises(ValueError):
        search.vector_search(q, v, 3, plan="other")


def test_filter_and_short_table(spark):
    q, v = frames(spark)
    got = found(search.vector_search(q, v, 500, where=F.col("label") == 1))
    assert got == brute(q, v, 500, keep=lambda r: r.label == 1)
    for plan in search.PLANS:
        assert found(search.vector_search(q, v.where("false"), 3, plan=plan)) == {}
        assert found(search.vector_search(q.where("false"), v, 3, plan=plan)) == {}
        nulls = v.withColumn("embedding", F.when(F.lit(False), F.col("embedding")))
        assert found(search.vector_search(q, nulls, 3, plan=plan)) == {}


def test_rank_is_one_based_and_ascending(spark):
    q, v = frames(spark)
    top = search.vector_search(q, v, 3).where("question_id = 3").orderBy("rank").collect()
    assert [r["rank"] for r in top] == [1, 2, 3] and [r.id for r in top] == [0, 1, 2]
    assert top[0].distance == 0.0


@pytest.mark.parametrize("plan", search.PLANS)
def test_lengths_must_agree(spark, plan):
    q, v = frames(spark)
    bad = spark.createDataFrame([(1000 + i, [1.0, 2.0], 0) for i in range(20)], "id long, embedding array<float>, label int")
    for asked, held in ((q, bad), (q, v.unionByName(bad)), (bad.select(F.col("id").alias("question_id"), "embedding"), v)):
        with pytest.raises(Exception, match="same length"):
            search.vector_search(asked, held, 1, plan=plan).collect()


def test_distance_expression(spark):
    q, v = frames(spark)
    pairs = q.where("question_id < 6").crossJoin(v.select("id", F.col("embedding").alias("e")))
    near = {(r.question_id, r.id): r.d for r in pairs.select("question_id", "id", rounded_distance(cosine_distance("embedding", "e")).alias("d")).collect()}
    assert near[(5, 1)] is None and near[(0, 150)] is None and near[(3, 7)] == 0.0
    hits = search.vector_search(q.where("question_id < 6"), v, 400).collect()
    assert all(abs(near[(h.question_id, h.id)] - h.distance) < 2e-9 for h in hits)


def clustered(spark, n, seed, name):
    """Vectors in 40 narrow clusters, one of which holds a third of them; some are copies."""
    r = np.random.default_rng(9)
    centres = r.normal(size=(40, 16))
    r = np.random.default_rng(seed)
    at = np.where(r.random(n) < 1 / 3, 0, r.integers(0, 40, n))
    rows = centres[at] + 0.03 * r.normal(size=(n, 16))
    rows[: n // 10] = rows[0]
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(rows)], f"{name} long, embedding array<float>")


def nearest_by_matrix(q, v, k):
    a, b = (np.array([r.embedding for r in df.orderBy(df.columns[0]).collect()], dtype="float64") for df in (q, v))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    d = np.round(1 - a @ b.T, 9) + 0.0
    at = np.argsort(d, axis=1, kind="stable")[:, :k]
    return at, np.take_along_axis(d, at, 1)


@pytest.mark.parametrize("build", [search.build_cells, search.pick_cells])
def test_cells_are_exact_and_leave_cells_out(spark, monkeypatch, build):
    monkeypatch.setattr(search, "BLOCK_BYTES", 100 * 128)
    q, v = clustered(spark, 300, 1, "question_id"), clustered(spark, 2000, 2, "id")
    cells = build(v, 40)
    assert cells.vectors.count() == v.count()
    at, d = nearest_by_matrix(q, v, 5)
    for rounds in (1, 2, 3):
        record = {}
        got = search.vector_search_cells(q, cells, 5, rounds=rounds, record=record).collect()
        assert {(r.question_id, r["rank"]): (r.id, round(r.distance, 8)) for r in got} == {
            (i, j + 1): (int(at[i, j]), round(float(d[i, j]), 8)) for i in range(len(at)) for j in range(5)
        }
        assert rounds == 1 or record["met"] < 0.3 * record["all"]
    few = search.vector_search_cells(q, cells, 3000).collect()  # more than there are: everything is a hit
    assert len(few) == 300 * 2000


def test_reuse_within_a_distance(spark):
    prompts, cache = clustered(spark, 2000, 3, "question_id"), clustered(spark, 2000, 4, "id").withColumn("answer", F.concat(F.lit("a"), "id"))
    at, d = nearest_by_matrix(prompts, cache, 1)
    tau = float(np.median(d))
    want = {(i, int(at[i, 0])) for i in range(2000) if d[i, 0] <= tau}
    record = {}
    cells = search.pick_cells(cache)
    search.vector_search_cells(prompts, cells, 1, tau, record=record).count()
    assert record["met"] < 0.2 * record["all"]
    for options in ({"plan": "scan_vectors"}, {"plan": "cells"}, {"cells": cells}):
        hits, misses = search.cached_answers(prompts, cache, tau, **options)
        assert {(r.question_id, r.id) for r in hits.collect()} == want
        assert misses.count() == 2000 - len(want)
    assert search.cached_answers(prompts, cache, -1.0, cells=cells)[0].count() == 0


def test_rerank(spark):
    hits = spark.createDataFrame([(1, 1, "a", 0.1), (1, 2, "b", 0.2), (1, 3, "c", 0.3)], "question_id int, rank int, id string, distance double")
    best = search.rerank(hits, F.col("distance") * 10, 2).orderBy("rank").collect()
    assert [(r.id, r["rank"]) for r in best] == [("c", 1), ("b", 2)]
    scored = search.score_pairs(hits.withColumn("q", F.lit("q")), lambda q, t: [float(ord(x)) for x in t], "q", "id")
    again = search.rerank(scored, -F.col("pair_score"), 1).collect()
    assert [r.id for r in again] == ["a"]


def test_cached_answers(spark):
    q = embed(spark.createDataFrame([(1, "refund please"), (2, "unrelated words entirely")], "question_id int, text string"))
    cache = embed(spark.createDataFrame([(9, "refund please", "yes")], "id int, text string, answer string"))
    hits, misses = search.cached_answers(q, cache, 0.1)
    assert [tuple(r) for r in hits.collect()] == [(1, 9, 0.0, "yes")]
    assert [r.question_id for r in misses.collect()] == [2]


def test_embed(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,)], "text string")
    rows = [r.embedding for r in embed(df).collect()]
    assert abs(sum(x * x for x in rows[0]) - 1) < 1e-6 and sorted(rows[0])[-1] == pytest.approx(2 / 5**0.5)
    assert not any(rows[1]) and not any(rows[2])
    own = embed(df, fn=lambda texts: [[len(t), 1] for t in texts]).collect()
    assert [list(r.embedding) for r in own] == [[5, 1], [0, 1], [0, 1]]
    assert len(embed(df, dim=200).first().embedding) == 200
