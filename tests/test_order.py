import random

import pytest
from pyspark.sql import functions as F

from docsift.operators import order
from docsift.operators.skew import durable


def test_group_index_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else None if rng.random() < 0.1 else f"g{rng.randrange(200)}", f"k{i:05d}") for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k string")
    want = {}
    for g in {g for g, _ in rows}:
        want.update({(g, k): (i, sum(h == g for h, _ in rows)) for i, k in enumerate(sorted(k for h, k in rows if h == g))})
    for limit in (order.BROADCAST_SHIFTS, 0):  # with and without a broadcast of the shifts
        order_limit, order.BROADCAST_SHIFTS = order.BROADCAST_SHIFTS, limit
        try:
            got = {(r.g, r.k): (r["index"], r.n) for r in order.group_index(df, ["g"], ["k"], total="n", range_rows=200).collect()}
        finally:
            order.BROADCAST_SHIFTS = order_limit
        assert got == want


def test_global_index_and_split(spark):
    rng = random.Random(2)
    keys = [None, *rng.sample(range(10_000), 999)]
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    at = {k: i for i, k in enumerate([None, *sorted(keys[1:])])}
    assert {r.k: r["index"] for r in order.global_index(df, ["k"], range_rows=70).collect()} == at
    back = {r.k: r["index"] for r in order.global_index(df, [F.desc("k")], range_rows=70).collect()}
    assert back == {k: 999 - i for k, i in at.items()}
    split = {r.k: r.split for r in order.ordered_split(df, ["k"], range_rows=70).collect()}
    assert split == {k: "train" if i < int(1000 * (1 - 0.15)) else "validation" for k, i in at.items()}


def test_index_over_ties_and_nothing(spark):
    df = spark.createDataFrame([(i % 3,) for i in range(300)], "k int")
    got = order.global_index(df, ["k"], range_rows=20).collect()
    assert sorted(r["index"] for r in got) == list(range(300))
    assert [r.k for r in sorted(got, key=lambda r: r["index"])] == sorted(i % 3 for i in range(300))
    assert order.global_index(df.where("k > 5"), ["k"], total="n").count() == 0


@pytest.mark.parametrize("n", [0, 1, 6, 7, 20])
def test_split_sizes(spark, n):
    df = spark.range(n)
    train = order.ordered_split(df, ["id"]).where("split = 'train'").count()
    assert train == int(n * (1 - 0.15))


def test_best_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    out = order.best_per_group(df, ["g"], [F.desc("id")], 2)
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in out.collect()) == [(0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1)]
    wide = order.best_per_group(spark.range(5000).select(F.lit(1).alias("g"), "id"), ["g"], ["id"], 2000)
    assert [r.id for r in wide.orderBy("rank").collect()] == list(range(2000))


def test_first_rows_and_sample(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x" * (201 if i % 2 else 200)) for i in range(50)], "i int, text string")
    got = order.sample_corpus(df, ["i"], limit=3).orderBy("i").collect()
    assert [(r.i, r.name) for r in got] == [(1, "arxiv_0000"), (3, "arxiv_0001"), (5, "arxiv_0002")]
    monkeypatch.setattr(order, "SMALL_LIMIT", 2)
    again = order.sample_corpus(df, ["i"], limit=3).orderBy("i").collect()
    assert [(r.i, r.name) for r in again] == [(r.i, r.name) for r in got]


def test_durable_reads_the_session_setting(spark):
    kept = durable(spark.range(3))
    assert kept.count() == 3 and spark.sparkContext.getCheckpointDir() is not None


def test_ranges_follow_bytes_and_stay_few(spark, monkeypatch):
    """Long rows fill ranges by bytes; short ranges of a large table grow instead of multiplying."""
    assert order.range_size(1000, 200) == 200
    assert order.range_size(512 * 9000, 8192) == 9000
    assert order.range_size(10**12, 150) == order.RANGE_ROWS
    ranges = []
    frame = type(spark.range(0))
    cut = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, n, *c: ranges.append(n) or cut(self, n, *c))
    monkeypatch.setattr(order, "RANGE_BYTES", 10_000)
    rows = spark.createDataFrame([(i, "x" * 1000 if i else None) for i in range(100)], "k int, t string")
    assert sorted((r.k, r["index"]) for r in order.global_index(rows, ["k"]).collect()) == [(i, i) for i in range(100)]
    monkeypatch.setattr(order, "MANY_RANGES", 5)
    numbers = rows.select("k")
    assert sorted((r.k, r["index"]) for r in order.global_index(numbers, ["k"], range_rows=2).collect()) == [(i, i) for i in range(100)]
    assert ranges == [11, 5]
