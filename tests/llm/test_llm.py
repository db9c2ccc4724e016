"""The operators against brute force on small tables with nulls, empty and long texts, ties and copies."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import chat, decontamination, fingerprints, licenses, ngram_join, packing, quality, substring_dedup, token_counts, toxicity
from docsift.llm.common import ascii_lower, hashes_of_texts, words
from docsift.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, anchor string, n long"


def texts():
    rng = random.Random(5)
    line = " ".join(f"common{i}" for i in range(15))
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    out = [None, "", "   ", "one", "two words", line, line, "x" * 40_000, "a b " * 300]
    for k in range(40):
        own = list(base)
        for _ in range(k % 5):
            own[rng.randrange(len(own))] = f"changed{rng.randrange(10**6)}"
        out.append(" ".join(own) + (f" {line}" if k % 3 else ""))
    return out + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(20)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark.createDataFrame([(i, t, None, "clash", i) for i, t in enumerate(texts())], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark, docs):
    return spark.createDataFrame([], SCHEMA)


def test_substring_removal(docs, nothing):
    first, want = {}, {}
    for i, t in enumerate(texts()):
        for j in range(len(words(t)) - 12):
            first.setdefault(tuple(words(t)[j : j + 13]), i)
    for i, t in enumerate(texts()):
        w = words(t)
        gone = {k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < i for k in range(j, j + 13)}
        want[i] = hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()
    assert {r.doc_id: r.kept_sha256 for r in substring_dedup.remove_repeats(docs).collect()} == want
    # the shards of whole windows find the same places
    unique = docs.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    whole, dealt = ({r.doc_id: sorted(set(r.windows)) for r in substring_dedup.repeated_windows(unique, split=n).collect()} for n in (10**6, 1))
    assert whole == dealt and whole
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_hashes_tell_words_apart():
    some = [None, "", " \t ", "Ab aB é ", "x", "ab\x0bba\u00a0c", "é x", " aa aaa a" * 50]
    for lower in (False, True):
        found = hashes_of_texts(some, lower)
        said = [words(ascii_lower(t) if lower else t) for t in some]
        assert [len(f) for f in found] == [len(w) for w in said]
        pairs = {(w, h) for ws, hs in zip(said, found) for w, h in zip(ws, hs.tolist())}
        assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})
    alone = [hashes_of_texts([t])[0].tolist() for t in some]
    assert alone == [f.tolist() for f in hashes_of_texts(some)] and hashes_of_texts([]) is not None


def test_ngram_join(docs, nothing):
    sets = {i: {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3)) if w} for i, w in enumerate(words(ascii_lower(t)) for t in texts())}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_components(docs).collect()}
    assert got == {i: (len(s), root[i]) for i, s in sets.items()}
    assert ngram_join.join_components(nothing).count() == 0


def test_token_counts_and_packing(docs, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts())}
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, tokenizer_path()).collect()} == {i: len(x) for i, x in ids.items()}
    pieces = packing.pack(docs, tokenizer_path(), group_rows=16, with_ids=True).collect()
    for i, x in ids.items():
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert [v for p in own for v in p.ids] == [*x, 0]
        assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in own)
    for _, group in itertools.groupby(sorted(pieces, key=lambda p: (p.sequence_id, p.offset)), key=lambda p: p.sequence_id):
        at = 0
        for p in group:
            assert p.offset == at
            at += p.length
        assert at <= 1024
    assert packing.pack(nothing, tokenizer_path()).count() == 0


def test_odd_texts_are_split_as_by_the_library():
    own = token_counts.PreTokens(tokenizer_path())
    for text in ("a<|endoftext|>b", "՘x 藤 \x1c y  z", "it's  \n\n x\t1,2 ", "\U0001f600 ok"):
        assert b"".join(own.pieces(text)) == own.encode(text)


def test_plain_texts_split_alike_and_words_are_encoded_in_one_call():
    import regex

    own, plain = token_counts.PreTokens(tokenizer_path()), [*map(chr, [*range(0x501), *range(0x2010, 0x2031), 0x20AC])]
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice(rng.choice((plain, "aé1 \n'", " '\u2028\x1c\x85tsdlv"))) for _ in range(40))
        assert own.split(text) == regex.findall(token_counts.PATTERN, text)
        assert b"".join(own.pieces(text)) == own.encode(text)
    calls = []
    own.cache, own.many = {}, lambda texts, **how: calls.append(len(texts)) or own.library.encode_batch(texts, **how)
    assert b"".join(own.pieces("Größe 12, naïve\nwords it's")) == own.encode("Größe 12, naïve\nwords it's") and calls == [1]


def test_first_fit_decreasing_against_a_scan():
    sizes = np.random.default_rng(1).integers(1, 100, 300)
    room: list[int] = []
    want = {}
    for item in np.argsort(-sizes, kind="stable"):
        at = next((b for b, r in enumerate(room) if r >= sizes[item]), len(room))
        room += [100] * (at == len(room))
        room[at] -= sizes[item]
        want[item] = at
    assert packing.first_fit_decreasing(sizes, 100)[0].tolist() == [want[i] for i in range(300)]


def test_fingerprints(docs, nothing):
    rows = {r.doc_id: r for r in fingerprints.edited(docs).collect()}
    all_ = texts()
    for i, t in enumerate(all_):
        t, following = t or "", all_[i - 1] or ""
        cut = len(t) // 3
        assert rows[i].edited_sha256 == hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest()
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
    assert rows[5].fingerprint == rows[6].fingerprint and rows[6].near_next == 1 and rows[0].fingerprint == ""
    assert fingerprints.edited(nothing).count() == 0


def test_tiling_finds_reordered_passages(spark, docs):
    item = " ".join(f"q{i}" for i in range(40))
    turned = "before " + " ".join(f"q{i}" for i in [*range(20, 40), *range(20)]) + " after"
    rows = spark.createDataFrame([(1, turned), (2, "q1 q2 q3 q4 q5 q6 other"), (3, None), (4, "")], "doc_id long, text string")
    got = decontamination.contaminated(rows, spark.createDataFrame([(9, item), (10, None), (11, "")], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.covered, len(r.tiles)) for r in got] == [(1, 9, 40, 2)]
    assert decontamination.contaminated(rows, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_licenses(spark):
    rows = [(1, "x y.\nReleased under the MIT License.\nfoo"), (2, None), (3, ""), (4, "licensed under the apache license version"), (5, "Licensed under the Apache License, Version 2.0. More.")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(1, "MIT"), (5, "Apache-2.0")]


def test_chat_reads_back(spark):
    rows = [(1, 0, "user", "a\\[INST] </s>\\\\"), (1, 1, "assistant", "[OUT] yes </s>"), (2, 0, None, None), (2, 0, "tool[:]", "x"), (3, 0, "assistant", "")]
    formatted = chat.format_turns(chat.probe(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    said = "</s>[INST] ok [/INST]"
    for conv, turns in ((1, [(r[2], r[3]) for r in rows[:2]]), (2, [("", ""), ("tool[:]", "x")]), (-7, [("user", said), ("assistant", said)])):
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [got[c].valid for c in (1, 2, 3)] == [True, False, False]


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    size = 2 * toxicity.DIM + 2
    h, wide = toxicity.HIDDEN, 2 * toxicity.HIDDEN + size
    shapes = {"A": (wide, h), "a": (h,), "o": (wide,), "c": (1,)} | {s + k: v for s in "lr" for k, v in (("W", (size, 3 * h)), ("U", (h, 2 * h)), ("V", (h, h)), ("b", (3 * h,)))}
    p = {k: rng.normal(0, 0.3, v) for k, v in shapes.items()}
    x, y = rng.normal(0, 1, (5, toxicity.WINDOW, size)), np.array([0, 1, 1, 0, 1.0])
    mask = np.ones((5, toxicity.WINDOW), bool)
    loss = lambda q: np.mean(np.logaddexp(0, z := toxicity.forward(x, mask, q)[0]) - y * z)
    g = toxicity.gradients(x, mask, y, p)
    for k, v in p.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        up, down = ({**p, k: v.copy()} for _ in range(2))
        up[k][at] += 1e-2
        down[k][at] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - g[k][at]) < 2e-3


@pytest.mark.parametrize("model", [toxicity, quality])
def test_classifiers_learn_and_take_empty_texts(model):
    rng = random.Random(1)
    text = lambda y: " ".join(("awful" if y and rng.random() < 0.2 else f"w{rng.randrange(50)}") + ("!!" if y else "") for _ in range(60))
    labels = [i % 2 for i in range(120)]
    fitted = model.fit([text(y) for y in labels], labels)
    scores = model.score(fitted, [text(1), text(0), "", None or ""])
    assert scores[0] > 0.5 > scores[1] and all(0 <= s <= 1 for s in scores)
    assert model.score(model.fit([], []), ["a"])[0] in (0.0, 0.5)
