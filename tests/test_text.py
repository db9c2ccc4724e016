import random

import pytest
from pyspark.sql import functions as F

from docsift.functions import text as tx
from docsift.operators import chunks as ch


def plain_chunks(text, size, overlap, min_chars):
    """The rule, stated again: windows of words at every step below the word count."""
    w = text.split()
    cut = [" ".join(w[s : s + size]) for s in range(0, len(w), size - overlap)]
    return [c for c in cut if len(c) > min_chars]


def test_whitespace_is_pythons(one):
    spaces = [chr(i) for i in range(0x10000) if chr(i).isspace()]
    assert len(spaces) == len(tx.WHITESPACE) == 29
    texts = [f"{s}a{s}{s}b{s}" for s in spaces] + ["​a​ b", "", " ", "a"]
    assert one(texts, tx.words) == [t.split() for t in texts]
    assert one(texts, tx.strip) == [t.strip() for t in texts]


@pytest.mark.parametrize("n,expected", [(0, 0), (1, 0), (448, 1), (449, 1), (512, 2), (513, 2)])
def test_chunk_counts(one, n, expected):
    got = one([" ".join(["abc"] * n)], tx.chunk_texts)[0]
    assert len(got) == expected
    if n == 512:  # the tail is nothing but the overlap
        assert len(got[1].split()) == 64


def test_chunks_match_the_rule(one):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n\t　é") for _ in range(rng.randrange(0, 400))) for _ in range(60)]
    for size, overlap, least in ((3, 1, 5), (5, 0, 20), (7, 6, 1)):
        got = one(texts, lambda c: tx.chunk_texts(c, size, overlap, least))
        assert got == [plain_chunks(t, size, overlap, least) for t in texts]


def test_chunk_arguments():
    with pytest.raises(ValueError):
        tx.chunk_texts("c", 64, 64)


def test_chunk_index_has_no_gap(spark):
    docs = spark.createDataFrame([("aaaaaaaaaaaa bbbbbbbbbbbb c d e f gggggggggggg hhhhhhhhhhhh", "x.txt")], "text string, source string")
    rows = ch.chunk_documents(docs, size=2, overlap=0).orderBy("id").collect()
    assert [(r.id, r.metadata.chunk_index) for r in rows] == [("x.txt_chunk_0", 0), ("x.txt_chunk_1", 1)]
    assert rows[1].text.startswith("ggg")


def test_manifest(spark):
    docs = spark.createDataFrame([("word " * 600, "a"), ("", "b"), (None, "c")], "text string, source string")
    assert [tuple(r) for r in ch.manifest(docs).collect()] == [(3, 2)]
    assert ch.manifest(docs.where("false")).collect() == []


def test_mail_body(one):
    mails = ["H: 1\n\n body \n", "no blank line ", "H\r\n\r\nbody", "H\n\na\n\nb", "\n\n", None, ""]
    assert one(mails, tx.mail_body) == ["body", "no blank line", "H\r\n\r\nbody", "a\n\nb", "", "", ""]


def test_truncate_and_training_text(one):
    assert one(["äöü𝄞x"], lambda c: tx.truncate(c, 4)) == ["äöü𝄞"]
    short = one(["a  b"], lambda c: tx.training_text(c, F.lit("{}")))[0]
    assert short == "### Receipt:\na  b\n\n### Extracted Fields:\n{}"
    long = one(["w " * 600], lambda c: tx.training_text(c, F.lit("{}"), 512))[0]
    assert len(long.split()) == 512


def test_qa_sources_cut_before_the_filter(spark):
    rows = [("f", i, "x" * (200 if i >= 2 else 10)) for i in range(6)]
    df = spark.createDataFrame(rows, "file string, pos int, text string")
    got = ch.qa_sources(df, ["file"], ["pos"], n=4).orderBy("pos").collect()
    assert [r.pos for r in got] == [2, 3]
