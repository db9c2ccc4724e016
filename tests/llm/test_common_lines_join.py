"""Texts of many common lines: what they share comes last in the order, however many such shingles there are."""

import random

import numpy as np

from docsift.llm import ngram_join
from docsift.llm.common import shared_folder

from test_shared_passage_join import components


def test_common_lines_make_no_pairs(spark, monkeypatch):
    """With 1,024 counts a task the prefixes held shingles of lines that several texts share, and pairs were built of them."""
    shared_folder(spark)
    rng = random.Random(8)
    lines = [" ".join(f"l{i}w{j}" for j in range(14)) for i in range(300)]
    texts = [" ".join([f"own{i}x{j}" for j in range(16)] + rng.sample(lines, 8)) for i in range(300)]
    texts += [t + " more" for t in texts[:20]]
    built, before = [], ngram_join.first_common
    monkeypatch.setattr(ngram_join, "first_common", lambda rows, percent: built.append(before(rows, percent).count()) or before(rows, percent))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs).collect()}
    assert got == dict(enumerate(components(texts, 4, 85))) and built == [0]


def test_most_frequent_shingles():
    values, counts = ngram_join._most_frequent(np.array([5, 3, 5, 9, 3, 5]), np.array([1, 1, 1, 4, 1, 1]), 2)
    assert dict(zip(values.tolist(), counts.tolist())) == {5: 3, 9: 4}
    none = np.zeros(0, np.int64)
    assert [len(x) for x in ngram_join._most_frequent(none, none, 2)] == [0, 0]


def test_frequent_shingles_by_count(spark, monkeypatch):
    rows = [(7, -1, 30, 2), (7, -1, -4, 9), (7, -1, 30, 3), (7, -1, 11, 2), (7, -1, 12, 2), (1, 50, 30, 99)]
    digests = spark.createDataFrame(rows, "doc_id long, n long, first long, second long")
    assert [x.tolist() for x in ngram_join.frequent(digests)] == [[-4, 11, 12, 30], [4, 1, 2, 3]]
    monkeypatch.setattr(ngram_join, "HEAVY", 3)  # the two of the last count stay out
    assert [x.tolist() for x in ngram_join.frequent(digests)] == [[-4, 30], [2, 1]]
    assert [len(x) for x in ngram_join.frequent(digests.filter("n > 0"))] == [0, 0]
