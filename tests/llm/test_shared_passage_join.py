"""Texts around one passage: no pairs by the square of their number, and no link is lost."""

import itertools
import random

import pytest

from docsift.llm import ngram_join
from docsift.llm.common import bit_filter, shared_folder, words


def around(own: int, start: int, passage: list[str]) -> str:
    return " ".join([f"own{start}x{i}" for i in range(own)] + passage)


def components(texts, size, percent):
    sets = [{tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if (w := words(t)) else set() for t in texts]
    root = list(range(len(texts)))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return [top(a) for a in range(len(texts))]


def test_texts_that_share_a_passage_are_not_paired(spark, monkeypatch):
    shared_folder(spark)
    passage = [f"p{i}" for i in range(135)]
    texts = [around(15, i, passage) for i in range(60)]  # 132 of 162 shingles in common: 81 %
    seen, before = [], ngram_join.first_common
    monkeypatch.setattr(ngram_join, "first_common", lambda rows, percent: seen.append(before(rows, percent).count()) or before(rows, percent))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs).collect()}
    assert got == dict(enumerate(range(60))) and seen == [0]


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_edited_texts_against_all_pairs(spark, size, percent):
    shared_folder(spark)
    rng = random.Random(size)
    texts = []
    for base in ([f"a{rng.randrange(500)}" for _ in range(90)], [f"b{i}" for i in range(30)]):
        for _ in range(45):
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(12)}"
            texts.append(" ".join(own[: len(own) - rng.randrange(len(base) // 5)] + [f"z{i}" for i in range(rng.randrange(4))]))
    want = components(texts, size, percent)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs, size, percent).collect()}
    assert got == dict(enumerate(want)) and 2 < len(set(want)) < len(texts)


def test_shingles_of_one_text_leave_before_the_join(spark):
    rows = spark.createDataFrame([(i, 9, 1, (i + 1) * 0x9E3779B97F4A7C1 % 2**63) for i in range(400)], "rep long, n long, position int, h long")
    kept = rows.filter("rep % 20 = 0").select("h")
    passed = ngram_join.of_hashes(rows, spark.sparkContext.broadcast(bit_filter(kept)))
    assert passed.schema == rows.schema and {r.rep for r in passed.collect()} == set(range(0, 400, 20))
