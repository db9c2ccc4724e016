"""Few distances of a block are sorted, and blocks of all pairs take over where bands leave little out."""

import numpy as np
import pytest

from docsift.operators import search

rng = np.random.default_rng(8)


@pytest.mark.parametrize("bounded", [False, True])
def test_few_near_equals_the_whole_sort(bounded):
    matrix, _, nearest, _ = search._block_functions(9)
    v = rng.normal(size=(3000, 16))
    v[700:730], v[5] = v[699], 0
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    q = np.concatenate([v[690:740], v[:20]])
    ids = rng.permutation(len(v))
    d = np.round(1.0 - q @ v.T, 9) + 0.0
    d[:, 5] = np.inf
    want = np.array([np.lexsort((ids, row))[:4] for row in d])
    far = np.take_along_axis(d, want, 1)
    got, at = nearest(q, v, ids, 4, far[:, -1] if bounded else None)
    real = q.any(axis=1)
    assert (got[real] == far[real]).all() and (at[real] == ids[want][real]).all() and np.isinf(got[~real]).all()


def test_vectors_without_structure_are_not_sent_once_per_band(spark, monkeypatch):
    monkeypatch.setattr(search, "GRID_PAIRS", 1)
    monkeypatch.setattr(search, "BLOCK_BYTES", 700 * 32 * 8)
    base = rng.normal(size=(1500, 32))
    v = spark.createDataFrame([(i, [float(x) for x in b]) for i, b in enumerate(base)], "id long, embedding array<double>")
    cells = search.pick_cells(v)
    sent = []
    meet = search._meet
    monkeypatch.setattr(search, "_meet", lambda q, *a: sent.append(q.count()) or meet(q, *a))
    got = search.vector_search_cells(v.withColumnRenamed("id", "question_id"), cells, 3).collect()
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    d = np.round(1.0 - unit @ unit.T, 9) + 0.0
    want = {(i, r + 1, int(j)) for i in range(len(d)) for r, j in enumerate(np.lexsort((np.arange(len(d)), d[i]))[:3])}
    assert {(r.question_id, r["rank"], r.id) for r in got} == want
    assert sent[-1] == len(base)
