"""Anchors and likeness against plain Python, and what they say about edited and reordered texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from docsift.llm import fingerprints

MASK = 0xFFFFFFFF


@pytest.fixture(scope="module", autouse=True)
def folder(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def _mix(h, k):
    k = k * 0xCC9E2D51 & MASK
    k = ((k << 15 | k >> 17) & MASK) * 0x1B873593 & MASK
    h ^= k
    return ((h << 13 | h >> 19) & MASK) * 5 + 0xE6546B64 & MASK


def _end(h, n):
    h ^= n
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK
    h ^= h >> 16
    return h - 2**32 if h >= 2**31 else h


def spark_hash(*values):
    """Spark's ``hash`` of texts and ints."""
    seed = 42
    for v in values:
        if isinstance(v, int):
            seed = _end(_mix(seed & MASK, v & MASK), 4)
        else:
            data, h = v.encode(), seed & MASK
            for i in range(0, len(data) // 4 * 4, 4):
                h = _mix(h, int.from_bytes(data[i : i + 4], "little"))
            for b in data[len(data) // 4 * 4 :]:
                h = _mix(h, (b - 256 if b > 127 else b) & MASK)
            seed = _end(h, len(data))
    return seed


def anchors_by_force(text):
    """hash -> first place."""
    text = (text or "").lower()
    w = [spark_hash(u) for u in re.findall(r"[一-鿿]|[^ \t\n\r\x0b\x0c一-鿿]+", text)]
    if not text:
        return {}
    if len(w) < 4:
        return {spark_hash(*w) if w else spark_hash(text): 1}
    m = [spark_hash(*w[i : i + 2]) for i in range(len(w) - 1)]
    out = {}
    for i in range(len(w) - 3):
        if min(m[i : i + 3]) in (m[i], m[i + 2]):
            out.setdefault(spark_hash(*w[i : i + 4]), i + 1)
    return out


def likeness_by_force(a, b):
    if a == b:
        return 1.0
    offsets = sorted(b[h] - a[h] for h in a.keys() & b.keys())
    if not offsets:
        return 0.0
    middle, reach = offsets[len(offsets) // 2], max(8, max(len(a), len(b)) * 3 / 16)
    return sum(max(0, 1 - abs(d - middle) / reach) for d in offsets) / len(a.keys() | b.keys())


def texts():
    rng = random.Random(2)
    base = [f"Word{rng.randrange(300)}" for _ in range(200)]
    out = [None, "", "   ", "one", "Two words é", "中文字符 is\tmixed 中", "a b " * 100, " ".join(base), " ".join(base[:90] + base[110:]), " ".join(base[20:])]
    return out + [" ".join(rng.choice(("x", "y", "z", "Ä", "w w")) for _ in range(rng.randrange(1, 40))) for _ in range(30)]


def test_anchors_and_likeness(spark):
    all_ = texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(all_)], "i int, t string").withColumn("a", fingerprints.anchors("t"))
    got = {r.i: {x >> 32: (x & MASK) >> 1 for x in r.a} for r in df.select("i", "a").collect()}
    want = {i: anchors_by_force(t) for i, t in enumerate(all_)}
    assert got == want
    pairs = df.select(F.col("i").alias("j"), F.col("a").alias("b")).crossJoin(df.select("i", "a"))
    for r in pairs.select("i", "j", fingerprints.likeness("a", "b").alias("x"), fingerprints.printed("a").alias("p")).collect():
        assert r.x == pytest.approx(likeness_by_force(want[r.i], want[r.j])), (r.i, r.j)
        assert r.p == "".join(f"{h & MASK:08X}" for h, _ in sorted(want[r.i].items()))


def test_edited_rows(spark, monkeypatch):
    ids = [-100, -17, -16, 0, 1, 2, 3, 500, 501, 2**60 + 1, 2**60 + 3]
    rng = random.Random(4)
    data = [(i, None if n == 3 else " ".join(rng.choice("abcdef") + "é" for _ in range(rng.randrange(60)))) for n, i in enumerate(ids)]
    docs = spark.createDataFrame([*data, data[5], (None, "lone text of nobody")], "doc_id long, text string").repartition(3)
    text_of = {i: t or "" for i, t in data}
    order = sorted(ids, reverse=True)
    following = {i: text_of[order[(n + 1) % len(order)]] for n, i in enumerate(order)}
    for broadcast in (fingerprints.BLOCKS, 1):
        monkeypatch.setattr(fingerprints, "BLOCKS", broadcast)
        monkeypatch.setattr(fingerprints, "LEAST_BLOCK", 16)
        rows = fingerprints.edited(docs).collect()
        assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted([*ids, ids[5]])
        for r in rows:
            own, after = (text_of[r.doc_id], following[r.doc_id]) if r.doc_id is not None else ("lone text of nobody", "")
            cut = len(own) // 3
            changed = own[: len(own) - cut] + after[:cut]
            assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(changed.encode()).hexdigest())
            assert r.near_edited == pytest.approx(likeness_by_force(anchors_by_force(own), anchors_by_force(changed)))
            if r.doc_id is not None:
                assert r.near_next == pytest.approx(likeness_by_force(anchors_by_force(own), anchors_by_force(after)))
    alone = fingerprints.edited(docs.filter("doc_id = 500")).first()
    assert alone.near_next == 1.0


def test_long_texts(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    changed = base[:9000] + [f"new{i}" for i in range(100)] + base[9100:]
    blocks = [base[i : i + 50] for i in range(0, 20_000, 50)]
    rng.shuffle(blocks)
    longer = base[:3000] + [f"new{i}" for i in range(500)] + base[3000:]
    other = [f"v{rng.randrange(5000)}" for _ in range(20_000)]
    versions = {"same": base, "changed": changed, "shuffled": [w for b in blocks for w in b], "longer": longer, "other": other}
    df = spark.createDataFrame([(k, " ".join(base), " ".join(v)) for k, v in versions.items()], "k string, t string, u string")
    near = {r.k: r.x for r in df.withColumns({"a": fingerprints.anchors("t"), "b": fingerprints.anchors("u")}).select("k", fingerprints.likeness("a", "b").alias("x")).collect()}
    assert near["same"] == 1.0 and 0.98 < near["changed"] < 1.0 and near["longer"] > 0.8
    assert near["shuffled"] < 0.3 and near["other"] < 0.01
