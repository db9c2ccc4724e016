"""Every operator on odd tables: ids above 2**53 beside a null, no rows, no labels, repeated rows, columns with names of its own."""

import pytest
from pyspark.sql import functions as F

from docsift.llm import chat, decontamination, fingerprints, importance, licenses, merkle, ngram_join, packing, quality, sharding, substring_dedup, token_counts, toxicity
from docsift.llm.queries import tokenizer_path

BIG = 2**60
PASSAGE = " ".join(f"passage{i}" for i in range(30))
LICENCE = "Licensed under the MIT License."
ROWS = [
    (BIG + 1, f"{PASSAGE}. {LICENCE} end"), (None, f"{PASSAGE} other words after it"), (BIG + 3, f"before it {PASSAGE}. {LICENCE}"),
    (None, None), (BIG + 5, ""), (BIG + 6, "   "), (BIG + 7, "word " * 400), (BIG + 1, f"{PASSAGE}. {LICENCE} end"),
]
CLASH = "doc_id long, text string, label int, n long, start int, place long, tree string, shard int, sum string, low long, y int, score double, anchor long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, "t", 5, "s", 6, 0, 0.5, 7) for i, t in rows], CLASH).repartition(2)


def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE, 9), (2, None, 9), (3, "", 9)], "item_id long, text string, doc_id long")


def labels(spark, rows=((BIG + 1, 1, 0), (BIG + 3, 0, 1), (BIG + 3, 0, 1), (BIG + 5, None, None), (None, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda s, d: fingerprints.edited(d),
    "op2": lambda s, d: decontamination.contaminated(d, benchmark(s)),
    "op3": lambda s, d: licenses.scan(d),
    "op4": lambda s, d: substring_dedup.remove_repeats(d),
    "op5": lambda s, d: packing.pack(d, tokenizer_path()),
    "op6": lambda s, d: token_counts.count_tokens(d, tokenizer_path()),
    "op7": lambda s, d: quality.classify(d, labels(s)),
    "op8": lambda s, d: toxicity.classify(d, labels(s)),
    "op9": lambda s, d: ngram_join.join_components(d),
    "op11": lambda s, d: merkle.manifest(d.withColumns({"source": F.lit("s"), "lang": F.lit(None).cast("string"), "n_chars": F.lit(1)})),
    "op12": lambda s, d: importance.resample(d, benchmark(s)),
    "op13": lambda s, d: sharding.shard_documents(d, 3),
}
SOME = {"op2": {BIG + 1, None, BIG + 3}, "op3": {BIG + 1, BIG + 3}}


@pytest.fixture(scope="module", autouse=True)
def folder(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_stay_and_rows_repeat(spark, name):
    got = [r.doc_id for r in OPERATORS[name](spark, frame(spark, ROWS)).collect()]
    want = [i for i, _ in ROWS if i in SOME.get(name, {i})]
    if name == "op2":
        want.remove(None)  # the other null id has no text
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    assert OPERATORS[name](spark, frame(spark, [])).collect() == []


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_no_labels(spark, operator):
    for known in (labels(spark, []), labels(spark, [(None, 1, 1)]), spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")):
        rows = operator.classify(frame(spark, ROWS), known).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert all(r.held_out is not None for r in rows)


def test_conversations(spark):
    turns = [(BIG + 1, 0, "user", "a"), (None, 0, "user", "b"), (BIG + 3, None, None, None), (BIG + 1, 0, "user", "a")]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, segments string, valid int")
    got = {r.conv_id: r.n_turns for r in chat.read_back(chat.format_turns(df)).collect()}
    assert got == {BIG + 1: 2, None: 1, BIG + 3: 1}
    assert chat.read_back(chat.format_turns(df.where("false"))).collect() == []
