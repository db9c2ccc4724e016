"""The stages of the corpus pipeline against brute force."""

import itertools
import random

import corpus_pipeline as pipeline
import pytest

from docsift.llm.common import ascii_lower, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table_of(spark, texts):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        pipeline.shared_folder(spark)
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], SCHEMA).repartition(3)


def shingles(text, size):
    w = words(ascii_lower(text))
    return {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1)) if w}


def near_copies():
    """Copies with a new end of 1 to 24 words, each of a text of its own; nulls, copies and repeated rows."""
    rng, out = random.Random(3), [(0, None), (1, ""), (2, "one"), (3, "one"), (3, "one")]
    for cut in range(1, 25):
        base = [f"w{rng.randrange(10**6)}" for _ in range(104)]
        out.append((10 * cut, " ".join(base)))
        out.append((10 * cut + 1, " ".join(base[:-cut] + [f"n{rng.randrange(10**6)}" for _ in range(cut)])))
    return out


def test_one_of_each_group_stays_by_five_words_and_four_fifths(spark):
    rows = near_copies()
    sets = {i: shingles(t, 5) for i, t in rows}
    likeness = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] & sets[b]}
    assert sum(0.8 <= x < 0.85 for x in likeness.values()) > 1 and sum(x < 0.8 for x in likeness.values()) > 1
    gone = {b for (_, b), x in likeness.items() if x >= 0.8}
    docs = table_of(spark, rows)
    got = sorted(r.doc_id for r in pipeline.keep_one_of_each_group(spark, docs, "").collect())
    assert got == sorted(i for i, _ in rows if i not in gone)
    assert pipeline.keep_one_of_each_group(spark, docs.limit(0), "").count() == 0


def kept_words(rows, size=13):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        for j in range(len(words(t)) - size + 1):
            first.setdefault(tuple(words(t)[j : j + size]), i)
    for i, t in rows:
        w = words(t)
        gone = {k for j in range(len(w) - size + 1) if first[tuple(w[j : j + size])] < i for k in range(j, j + size)}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    return out


def test_repeats_leave_and_repeated_rows_stay_two(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(0, None), (1, ""), (2, f"a b {passage} c"), (3, f"d {passage} e  f"), (3, f"d {passage} e  f"), (4, passage), (4, passage), (5, "own  text")]
    docs = table_of(spark, rows)
    got = sorted((r.doc_id, r.text or "", r.n_chars) for r in pipeline.remove_repeats(spark, docs, "").collect())
    assert got == sorted((i, t or "", len(t or "")) for i, t in kept_words(rows)) and len(got) == len(rows)
    assert pipeline.remove_repeats(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize("verdicts", [{2, 3}, set()])
def test_verdicts_and_benchmark_drop_documents(spark, monkeypatch, verdicts):
    item = " ".join(f"q{i}" for i in range(40))
    rows = [(0, None), (1, ""), (2, "x y"), (3, "z"), (3, "z"), (4, f"u {item} v"), (4, f"u {item} v"), (5, "q1 q2 q3")]
    docs = table_of(spark, rows)
    benchmark = spark.createDataFrame([(9, item), (10, None), (11, "")], "item_id long, text string")
    monkeypatch.setattr(pipeline, "table", lambda spark, folder, name: benchmark)
    monkeypatch.setattr(pipeline.toxicity, "classify", lambda docs, labels: docs.selectExpr("doc_id", f"cast(doc_id in ({', '.join(map(str, verdicts or {-1}))}) as int) as predicted"))
    for stage, gone in ((pipeline.drop_toxic, verdicts), (pipeline.decontaminate, {4})):
        assert sorted((r.doc_id, r.text) for r in stage(spark, docs, "").select("doc_id", "text").fillna("-").collect()) == sorted((i, "-" if t is None else t) for i, t in rows if i not in gone)
        assert stage(spark, docs.limit(0), "").count() == 0


def test_every_token_is_packed(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(pipeline.tokenizer_path())
    rows = [(0, None), (1, ""), (2, "x y"), (3, "many words " * 900)]
    docs, want = table_of(spark, rows), {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows}
    got = dict.fromkeys(want, 0)
    for r in pipeline.pack_documents(spark, docs, "").collect():
        got[r.doc_id] += r.length
    assert got == want and pipeline.pack_documents(spark, docs.limit(0), "").count() == 0
