"""Quality by nearest-neighbour voting over latent-semantic vectors.

Texts become counts of hashed character trigrams and word shapes of the whole text, weighted by
rarity and projected on the leading singular vectors, both fitted on the sample (at most
``SAMPLE`` labelled rows). The labelled vectors are broadcast (``SAMPLE`` x ``RANK`` floats, under
2 MB); every document's exact cosines to all of them are computed in blocks, and the nearest
vote with their similarity. Empty and null texts are refused (0). Without labels of both kinds every
text gets the one that there is, and without any 0.5. Rows are scored one by one, so repeated rows and null ids
get their own score; columns beyond doc_id and text are not read, and an empty table gives no rows.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame

from docsift.llm import models

SAMPLE, RANK, WIDTH, NEIGHBOURS = 3000, 48, 4096, 15


def features(text: str) -> np.ndarray:
    """Hashed counts: character trigrams of the lowered text, and the shapes of its words."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out = np.zeros(2 * WIDTH, np.float32)
    if len(codes) < 3:
        return out
    kinds = np.where(codes == 32, 0, np.where(codes == 10, 1, np.where((codes >= 48) & (codes < 58), 2, np.where((codes >= 65) & (codes < 91), 3, np.where(codes < 65, 4 + codes % 24, np.where(codes < 123, 30, np.where(codes < 192, 31, 32)))))))
    kinds = kinds.astype(np.uint64)
    for base, values in ((0, codes), (WIDTH, kinds)):
        grams = (values[:-2] * np.uint64(1000003) + values[1:-1]) * np.uint64(998244353) + values[2:]
        slots = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int64)
        out[base : base + WIDTH] = np.bincount(slots, minlength=WIDTH)[:WIDTH]
    out[:WIDTH] /= len(codes)
    out[WIDTH:] /= len(codes)
    return out


def _weighted(texts: list[str], idf: np.ndarray) -> np.ndarray:
    x = np.sqrt(np.stack([features(t) for t in texts])) * idf
    x[:, :WIDTH] *= 0.5
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(texts: list[str], labels: list[int]) -> dict | None:
    if len(set(labels)) < 2:
        return {"prior": float(labels[0]) if labels else 0.5}
    y = np.array(labels, np.float32)
    present = np.zeros(2 * WIDTH)
    for text in texts:
        present += features(text) > 0
    idf = np.log((1 + len(texts)) / (1 + present)).astype(np.float32) + 0.1
    x = _weighted(texts, idf)
    mean = x.mean(axis=0)
    x = x - mean
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(x.T @ (x @ (x.T @ rng.standard_normal((len(x), RANK)).astype(np.float32))))[0]
    small = x @ basis
    turn = np.linalg.svd(small, full_matrices=False)[2].T
    basis = (basis @ turn).astype(np.float32)
    counts = np.bincount(y.astype(int), minlength=2)
    return {"idf": idf, "mean": mean, "basis": basis, "vectors": _unit(x @ basis), "y": y, "weight": np.where(y > 0, 1 / counts[1], 1 / counts[0]) * len(y) / 2}


def score(model: dict, texts: list[str]) -> list[float]:
    if "basis" not in model:
        return [model["prior"]] * len(texts)
    out, full = np.zeros(len(texts)), [i for i, t in enumerate(texts) if t]
    if not full:
        return out.tolist()
    own = _unit((_weighted([texts[i] for i in full], model["idf"]) - model["mean"]) @ model["basis"])
    cosines = own @ model["vectors"].T
    k = min(NEIGHBOURS, cosines.shape[1])
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6) ** 4 * model["weight"][near]
    out[full] = (votes * model["y"][near]).sum(axis=1) / votes.sum(axis=1)
    return np.clip(out, 0, 1).tolist()


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    test = models.held_out(3, 1)
    model = models.fit_in_task(models.sample(docs, labels, "quality", ~test, SAMPLE), fit)
    return models.scored(docs, model, score, test)
