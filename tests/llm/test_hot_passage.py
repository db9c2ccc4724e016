"""A passage in many surroundings has no automaton and no list of its documents."""

import random

from docsift.llm import substring_dedup
from docsift.llm.common import shared_folder, words


def test_hot_anchors_need_no_automaton(spark, monkeypatch):
    shared_folder(spark)
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(80):
        around = [f"u{rng.randrange(10**6)}" for _ in range(20)]
        cut = rng.randrange(0, 12)
        rows.append((i, " ".join(around[:10] + passage[cut:] + around[10:] + (passage if i % 9 == 0 else []))))
    first, want = {}, {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    for i, t in rows:
        w = words(t)
        places = [j for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i]
        if places:
            want[i] = places
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def broken():
        raise AssertionError("an automaton holds a hot anchor")

    monkeypatch.setattr(substring_dedup, "SuffixAutomaton", lambda: broken())
    got = {r.doc_id: sorted(set(r.windows)) for r in substring_dedup.repeated_windows(docs, split=1).collect()}
    assert got == want and len(want) > 70
