"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a word are its own features (a hashed embedding and its label odds) and those of its
characters (the mean embedding of its hashed character n-grams and their highest label odds); odds
are counted on the sample. The network reads windows of ``WINDOW`` words, half overlapping, over
the whole text; a text's score is its highest window. Windows are trained as instances of their
text: of a toxic text the ones with the highest odds, of others all. At most ``SAMPLE`` labelled
rows are used. Null and empty texts get a clean score (0). Without labels of both kinds every text gets
the one that there is, and without any 0. Rows are scored one by one, so repeated rows and null ids get
their own score; columns beyond doc_id and text are not read, and an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from docsift.llm import models
from docsift.llm.common import kept_by_worker

SAMPLE, WINDOW, HIDDEN, SLOTS, DIM, BLOCK = 4000, 16, 8, 1 << 15, 4, 1 << 13
WIDE = 2 * DIM + 2
WORD = re.compile(r"[^\W\d_]+")
GRAMS = (4, 5)
_BYTES = np.random.default_rng(31).integers(0, 2**64, 256, np.uint64)
_STEP, _MIX = np.uint64(0x5851F42D4C957F2D), np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def slots(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots of the words themselves, and per n-gram size those of their character n-grams (over the
    bytes of the word between marks), word after word, each with its number per word."""
    encoded = [f"<{w}>".encode("utf-8", "surrogatepass") for w in words]
    spare = max(GRAMS) - 3
    data = _BYTES[np.frombuffer(b"".join(e + bytes(spare) for e in encoded) + bytes(max(GRAMS)), np.uint8)]
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
    begins = np.cumsum(lengths + spare) - lengths - spare
    place = np.arange(len(data)) - np.repeat(np.r_[begins, len(data)], np.r_[lengths + spare, max(GRAMS)])
    powers = np.multiply.accumulate(np.full(int(lengths.max(initial=0)) + spare + 1, _STEP, np.uint64))
    whole = np.add.reduceat(data * powers[np.maximum(place, 0)], begins)
    out = [(_slot(whole), np.ones(len(words), np.int64))]
    for size in GRAMS:
        counts = np.maximum(lengths - size + 1, 1)
        at = ragged(begins, counts)
        value = np.zeros(len(at), np.uint64)
        for step in range(size):
            value = value * _STEP + data[at + step]
        out.append((_slot(value), counts))
    return out


def _slot(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(32))
    return ((value * _MIX) >> np.uint64(64 - 15)).astype(np.uint16)


def ragged(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... (counts[0] of them), begins[1], ..."""
    return np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _present(texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the distinct slots of its words and of their character n-grams."""
    number: dict[str, int] = {}
    rows = [np.fromiter((number.setdefault(t, len(number)) for t in set(tokens)), np.int64) for tokens in texts]
    if not number:
        return [(np.zeros(0, np.uint16),) * 2 for _ in texts]
    (word, _), *grams = slots(list(number))
    begins = [np.cumsum(counts) - counts for _, counts in grams]
    return [(np.unique(word[at]), np.unique(np.concatenate([g[ragged(b[at], n[at])] for (g, n), b in zip(grams, begins)]))) for at in rows]


def _odds(present: list[np.ndarray], labels: list[int]) -> np.ndarray:
    """Log odds of a slot by the share of texts of each label that have it, shrunk by support."""
    counts = np.zeros((2, SLOTS))
    for at, y in zip(present, labels):
        counts[y, at] += 1
    n = np.bincount(labels, minlength=2)
    share = (counts + 0.5) / (n[:, None] + 1)
    support = counts.sum(axis=0)
    return np.clip(np.log(share[1] / share[0]) * support / (support + 4), -4, 4).astype(np.float32)


class Inputs:
    """Input rows of words under one model. Row 0 is no word. Known words are forgotten at ``LIMIT``."""

    LIMIT = 200_000

    def __init__(self, model: dict):
        self.model, self.known = model, {}
        self.rows = np.zeros((1, WIDE), np.float32)

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """Row numbers of the tokens, valid until the next call."""
        if len(self.known) > self.LIMIT:
            self.known, self.rows = {}, self.rows[:1]
        missing = [t for t in set(tokens) if t not in self.known]
        if missing:
            self.known.update(zip(missing, range(len(self.rows), len(self.rows) + len(missing))))
            self.rows = np.concatenate([self.rows, self._fresh(missing)])
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    def _fresh(self, words: list[str]) -> np.ndarray:
        (word, _), *grams = slots(words)
        total, highest, count = np.zeros((len(words), DIM), np.float32), np.full(len(words), -np.inf, np.float32), 0
        for at, counts in grams:
            chars, begins = self.model["char"][at], np.cumsum(counts) - counts
            total += np.add.reduceat(chars[:, :DIM], begins)
            highest = np.maximum(highest, np.maximum.reduceat(chars[:, DIM], begins))
            count = count + counts
        return np.column_stack([self.model["word"][word], total / count[:, None], self.model["word_odds"][word], highest]).astype(np.float32)


def windows(count: int) -> np.ndarray:
    """Starts of all windows over ``count`` words."""
    return np.arange(0, max(1, count - WINDOW // 2), WINDOW // 2)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gru(x: np.ndarray, p: dict, side: str, back: bool, keep: bool):
    """Hidden states (rows, WINDOW, HIDDEN) and, with ``keep``, what the gradient needs."""
    rows, steps, _ = x.shape
    h, states, kept = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, steps, HIDDEN), np.float32), []
    pre = x @ p[side + "W"] + p[side + "b"]
    for t in range(steps - 1, -1, -1) if back else range(steps):
        gates = _sigmoid(pre[:, t, : 2 * HIDDEN] + h @ p[side + "U"])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        c = np.tanh(pre[:, t, 2 * HIDDEN :] + (r * h) @ p[side + "V"])
        if keep:
            kept.append((t, h, z, r, c))
        h = z * h + (1 - z) * c
        states[:, t] = h
    return states, kept


def forward(x: np.ndarray, mask: np.ndarray, p: dict, keep: bool = False):
    left, kept_l = _gru(x, p, "l", False, keep)
    right, kept_r = _gru(x, p, "r", True, keep)
    h = np.concatenate([left, right, x], axis=2)
    a = np.where(mask, (np.tanh(h @ p["A"]) @ p["a"]), -30)
    a = np.exp(a - a.max(axis=1, keepdims=True))
    a /= a.sum(axis=1, keepdims=True)
    pooled = (h * a[:, :, None]).sum(axis=1)
    return pooled @ p["o"] + p["c"], (h, a, pooled, kept_l, kept_r)


def gradients(x, mask, y, p):
    logit, (h, a, pooled, kept_l, kept_r) = forward(x, mask, p, True)
    g, d = {}, ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
    g["o"], g["c"] = pooled.T @ d, d.sum(keepdims=True)
    d_pool = d[:, None] * p["o"]
    d_a = (h * d_pool[:, None]).sum(axis=2)
    d_s = a * (d_a - (a * d_a).sum(axis=1, keepdims=True)) * mask
    t = np.tanh(h @ p["A"])
    g["a"] = np.einsum("bth,bt->h", t, d_s)
    d_t = d_s[:, :, None] * p["a"] * (1 - t * t)
    g["A"] = np.einsum("bti,bth->ih", h, d_t)
    d_h = a[:, :, None] * d_pool[:, None] + d_t @ p["A"].T
    for side, kept, at in (("l", kept_l, 0), ("r", kept_r, HIDDEN)):
        W, U, V = (np.zeros_like(p[side + k]) for k in "WUV")
        b, carry = np.zeros_like(p[side + "b"]), np.zeros((len(x), HIDDEN), np.float32)
        for step, before, z, r, c in reversed(kept):
            dh = d_h[:, step, at : at + HIDDEN] + carry
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            drh = dc @ p[side + "V"].T
            dr = drh * before * r * (1 - r)
            pre = np.concatenate([dz, dr, dc], axis=1)
            W += x[:, step].T @ pre
            b += pre.sum(axis=0)
            U += before.T @ pre[:, : 2 * HIDDEN]
            V += (r * before).T @ dc
            carry = dh * z + drh * r + pre[:, : 2 * HIDDEN] @ p[side + "U"].T
        g[side + "W"], g[side + "U"], g[side + "V"], g[side + "b"] = W, U, V, b
    return g


def cut(numbers: np.ndarray) -> np.ndarray:
    """Row numbers of all overlapping windows of a text, 0 after its end."""
    starts = windows(len(numbers))
    padded = np.zeros(starts[-1] + max(WINDOW, len(numbers) - starts[-1]), np.int64)
    padded[: len(numbers)] = numbers
    return padded[starts[:, None] + np.arange(WINDOW)]


def highest(cuts: list[np.ndarray], rows: np.ndarray, net: dict) -> np.ndarray:
    """The highest logit of each text's windows."""
    best = np.full(len(cuts), -np.inf)
    owner, whole = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts]), np.concatenate(cuts)
    for at in range(0, len(whole), BLOCK):
        part = whole[at : at + BLOCK]
        np.maximum.at(best, owner[at : at + BLOCK], forward(rows[part], part > 0, net)[0])
    return best


def fit(texts: list[str], labels: list[int]) -> dict:
    if len(set(labels)) < 2:
        return {"prior": float(labels[0]) if labels else 0.0}
    rng = np.random.default_rng(11)
    tokens = [tokens_of(t) for t in texts]
    # odds for the network come from the other half, so that it learns how far they can be trusted
    half = [0] * len(texts)
    for y in (0, 1):
        for turn, i in enumerate(i for i in range(len(texts)) if labels[i] == y):
            half[i] = turn % 2
    model = {"word": rng.normal(0, 0.1, (SLOTS, DIM)).astype(np.float32), "char": rng.normal(0, 0.1, (SLOTS, DIM)).astype(np.float32)}
    present = _present(tokens)
    xs, ys = [], []
    for part in (0, 1):
        other = [i for i in range(len(texts)) if half[i] != part]
        side = Inputs(_with_odds(model, [present[i] for i in other], [labels[i] for i in other]))
        for i in (i for i in range(len(texts)) if half[i] == part and tokens[i]):
            windows_ = cut(side.numbers(tokens[i]))
            top = (side.rows[windows_, -2] + side.rows[windows_, -1]).max(axis=1)
            if labels[i]:
                keep = np.argsort(-top)[:2]
            else:
                keep = np.unique(np.r_[np.argsort(-top)[:8], rng.integers(0, len(windows_), 4)])
            xs.append((side.rows[windows_[keep]], windows_[keep] > 0))
            ys.append(np.full(len(keep), labels[i], np.float32))
    if not xs:
        return {"prior": 0.0}
    x, mask, y = (np.concatenate(part) for part in (*zip(*xs), ys))
    size = WIDE
    wide = 2 * HIDDEN + size
    p = {"A": rng.normal(0, 0.2, (wide, HIDDEN)), "a": rng.normal(0, 0.2, HIDDEN), "o": rng.normal(0, 0.2, wide), "c": np.zeros(1)}
    for side in "lr":
        p |= {side + "W": rng.normal(0, 0.3, (size, 3 * HIDDEN)), side + "U": rng.normal(0, 0.2, (HIDDEN, 2 * HIDDEN)), side + "V": rng.normal(0, 0.2, (HIDDEN, HIDDEN)), side + "b": np.zeros(3 * HIDDEN)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, 701):
        at = rng.integers(0, len(y), 256)
        for k, grad in gradients(x[at], mask[at], y[at], p).items():
            m1[k] = 0.9 * m1[k] + 0.1 * grad
            m2[k] = 0.999 * m2[k] + 0.001 * grad * grad
            p[k] = p[k] - np.float32(0.01) * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + np.float32(1e-8))
    net = {k: v.astype(np.float32) for k, v in p.items()}
    # the highest window of a text decides, so the bias is set by texts: a clean text lost weighs most
    best = np.full(len(xs), -np.inf)
    owner = np.repeat(np.arange(len(xs)), [len(part) for part in ys])
    for at in range(0, len(y), BLOCK):
        np.maximum.at(best, owner[at : at + BLOCK], forward(x[at : at + BLOCK], mask[at : at + BLOCK], net)[0])
    truth = np.array([part[0] for part in ys])
    at = np.unique(best)
    cuts = (at[1:] + at[:-1]) / 2
    cost = [0.03 * (best[truth == 1] < t).mean() + 0.97 * (best[truth == 0] >= t).mean() for t in cuts]
    net["c"] = net["c"] - np.float32(cuts[int(np.argmin(cost))] if len(cuts) else 0)
    return _with_odds(model, present, labels) | {"prior": 0.0, "net": net}


def _with_odds(base: dict, present: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> dict:
    word, char = (_odds([p[at] for p in present], labels) for at in (0, 1))
    return base | {"word_odds": word, "char": np.concatenate([base["char"], char[:, None]], axis=1)}


def score(model: dict, texts: list[str]) -> list[float]:
    if "net" not in model:
        return [model["prior"]] * len(texts)
    kept = kept_by_worker("toxicity")
    if "inputs" not in kept or kept["inputs"].model is not model:
        kept["inputs"] = Inputs(model)
    inputs, out, block, held = kept["inputs"], [0.0] * len(texts), [], 0

    def flush() -> None:
        numbers = inputs.numbers([t for _, tokens in block for t in tokens])
        cuts = [cut(part) for part in np.split(numbers, np.cumsum([len(tokens) for _, tokens in block])[:-1])]
        for (i, _), logit in zip(block, highest(cuts, inputs.rows, model["net"])):
            out[i] = float(_sigmoid(np.float32(logit)))
        block.clear()

    for i, text in enumerate(texts):
        tokens = tokens_of(text)
        if tokens:
            block.append((i, tokens))
            held += len(tokens)
        if held >= BLOCK:
            flush()
            held = 0
    if block:
        flush()
    return out


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    test = models.held_out(5, 0)
    model = models.fit_in_task(models.sample(docs, labels, "toxic", ~test, SAMPLE), fit)
    return models.scored(docs, model, score, test, "toxicity")
