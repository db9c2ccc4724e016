import json

import pytest
from pyspark.sql import functions as F

from docsift.operators import extraction, mail, review
from docsift.operators.embedding import embed
from docsift.plans import jobs
from docsift.sources import readers, sinks


def test_corpus(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\rthree")
    (tmp_path / "b.TXT").write_text("no")
    (tmp_path / "c.md").write_text("no")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.txt").write_text("no")
    rows = readers.read_corpus(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("one\ntwo\nthree", "a.txt")]


def test_mail_csv(spark, tmp_path):
    path = tmp_path / "mail.csv"
    path.write_bytes(
        b'file,message\n1,"H: 1\n\nsaid ""hi"", twice, and that is long enough to be kept as a body"\n2,NA\n3,\n'
        b'4,"H: 2\r\n\r\nthis one keeps its line ends, so it has no blank line at all"\n5,"H\n\nshort"\n'
    )
    df = readers.read_mail_csv(spark, str(path))
    rows = {r.file: r.message for r in df.collect()}
    assert rows["2"] is None and rows["3"] is None and "\r\n\r\n" in rows["4"] and 'said "hi", twice' in rows["1"]
    clean = mail.clean_mail(df, ["file"], max_samples=2).collect()
    assert [r.file for r in clean] == ["1", "4"]  # nulls first, then the cut, then the length
    assert [r.file for r in mail.clean_mail(df, ["file"], max_samples=3).collect()] == ["1", "4"]


def test_qa_pairs_and_numbering(spark, tmp_path):
    pairs = [{"question": f"q{i}", "answer": f"a{i}", "verified": i < 2} for i in range(3)]
    (tmp_path / "qa.json").write_text(json.dumps(pairs, indent=1))
    df = readers.read_qa_pairs(spark, str(tmp_path / "qa.json"))
    from docsift.operators.chunks import verified

    assert verified(df).count() == 3 and verified(df, verified_only=True).count() == 2
    rows = jobs.number_questions(df, ["question"]).orderBy("id").collect()
    assert [(r.id, r.question, r.ground_truth) for r in rows] == [(i, f"q{i}", f"a{i}") for i in range(3)]


def test_chunks_keep_their_order(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"text": f"t{i}"} for i in range(30)], indent=1))
    (tmp_path / "b.jsonl").write_text("".join(json.dumps({"content": f"c{i}", "text": None} if i == 3 else {"content": f"c{i}"}) + "\n" for i in range(30)))
    df = readers.read_chunks(spark, str(tmp_path))
    for name, letter in (("a.json", "t"), ("b.jsonl", "c")):
        got = [r.text for r in df.where(F.col("file") == name).orderBy("pos").collect()]
        assert got == [f"{letter}{i}" for i in range(30)]
    from docsift.operators.chunks import qa_sources

    first = qa_sources(df, ["file"], ["pos"], n=20, min_chars=0).orderBy("file", "pos").collect()
    assert [r.text for r in first] == [f"t{i}" for i in range(20)] + [f"c{i}" for i in range(20)]


def test_receipts(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"r{i}.txt").write_text(f"  shop {i}\n")
        if i != 3:
            (tmp_path / f"r{i}.json").write_text(json.dumps({"company": f"shop {i}"}))
    out = tmp_path / "out"
    records = jobs.prepare_receipts(spark, str(tmp_path), str(out)).orderBy("stem").collect()
    assert [(r.stem, r.input, r.split) for r in records] == [(f"r{i}", f"shop {i}", "train" if i < 6 else "validation") for i in (0, 1, 2, 4, 5, 6)]
    assert json.loads(records[0].output) == {"company": "shop 0"} and "shop 0" in records[0].training_text
    saved = [json.loads(line) for p in (out / "validation").glob("*.json") for line in p.read_text().splitlines()]
    assert [s["input"] for s in saved] == ["shop 6"]


def test_normalise_receipts(spark):
    df = spark.createDataFrame([("t", ["a", "b"], "c"), (None, ["a", "b"], None), (None, None, "c")], "text string, words array<string>, company string")
    rows = extraction.normalise_receipts(df).collect()
    assert [(r.input, json.loads(r.output)) for r in rows] == [
        ("t", {"company": "c", "date": "", "address": "", "total": ""}),
        ("a b", {"company": "", "date": "", "address": "", "total": ""}),
        ("", {"company": "c", "date": "", "address": "", "total": ""}),
    ]


def test_vector_table_keeps_the_first_row(spark, tmp_path):
    path = str(tmp_path / "vectors")
    schema = "id string, text string"
    first = embed(spark.createDataFrame([("a", "one"), ("b", "two")], schema))
    second = embed(spark.createDataFrame([("b", "changed"), ("c", "three")], schema))
    assert sinks.append_vectors(first, path) == 2 and sinks.append_vectors(second, path) == 2
    assert {r.id: r.text for r in readers.read_vectors(spark, path).collect()} == {"a": "one", "b": "two", "c": "three"}
    twice = embed(spark.createDataFrame([("d", "x"), ("d", "y")], schema))
    with pytest.raises(Exception, match="id occurs twice"):
        sinks.append_vectors(twice, path)
    assert readers.read_vectors(spark, path).count() == 3


def test_an_append_counts_once_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "vectors")
    schema = "id string, text string"
    batch = spark.createDataFrame([("a", "one"), (None, "two"), (None, None), (None, "two")], schema).repartition(3)
    assert sinks.append_vectors(batch, path) == 4 and sinks.append_vectors(batch, path) == 4
    held = sorted((r.id, r.text) for r in readers.read_vectors(spark, path).select("id", F.coalesce("text", F.lit("-")).alias("text")).collect())
    assert held == [("a", "one"), ("doc_0", "-"), ("doc_2", "two"), ("doc_3", "two")]
    assert sinks.append_vectors(batch.drop("id"), str(tmp_path / "unnamed")) == 4
    assert {r.id for r in readers.read_vectors(spark, str(tmp_path / "unnamed")).collect()} == {f"doc_{i}" for i in range(4)}
    more = spark.createDataFrame([("z", "new")], schema)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(sinks, "name_vector_parts", killed)
        with pytest.raises(RuntimeError):
            sinks.append_vectors(more, path)
    assert readers.read_vectors(spark, path).count() == 4  # the folder is there, but nothing names it
    number, parts = readers.vector_parts(spark, path)
    (tmp_path / "vectors" / readers.MANIFESTS / f"{number + 1:010d}").write_text(parts[0])  # cut off while it was written
    assert readers.vector_parts(spark, path) == (number + 1, parts)
    with pytest.raises(Exception, match="xist"):
        sinks.name_vector_parts(spark, path, number + 1, parts)
    assert sinks.append_vectors(more, path) == 1 and readers.read_vectors(spark, path).count() == 5
    with pytest.raises(FileNotFoundError):
        readers.read_vectors(spark, str(tmp_path / "none"))


def test_append_tables(spark, tmp_path):
    path = str(tmp_path / "feedback")
    df = spark.createDataFrame([("q", "a", "bad_answer")], "question string, answer string, reason string")
    sinks.append_feedback(df, path)
    sinks.append_feedback(df, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="reason is missing"):
        sinks.append_feedback(df.withColumn("reason", F.lit(None).cast("string")), path)
    fixes = spark.createDataFrame([("r", {"total": "1"}, {"total": "2"})], "receipt_text string, predicted struct<total:string>, corrected struct<total:string>")
    sinks.append_corrections(fixes, str(tmp_path / "fixes"))
    assert spark.read.parquet(str(tmp_path / "fixes")).first().corrected.total == "2"


def test_review_tables(spark):
    gold = spark.createDataFrame([("q1", "a1"), ("q1", "a1")], "question string, answer string")
    more = spark.createDataFrame([("q1", "x"), ("q2", "y"), ("q2", "y")], "question string, answer string")
    assert sorted(tuple(r) for r in review.extend_gold(gold, more).collect()) == [("q1", "a1")] * 2 + [("q2", "y")] * 2
    one = review.queue_item(gold, "answer", F.col("question"), F.lit("low score"), F.lit(0.5))
    two = review.queue_item(more, "draft", F.col("question"), F.lit("approval"))
    assert review.review_queue(one, two).count() == 5


def test_the_latest_review_wins(spark):
    records = spark.createDataFrame([("r1", "old"), ("r1", "old"), ("r2", "old"), (None, "old")], "input string, output string")
    kind = "struct<total:string>"
    rows = [
        ("r1", ("1",), ("2",), 5), ("r1", ("1",), ("3",), 7), ("r1", ("1",), ("4",), 7), ("r1", ("9",), None, 6), ("r1", ("8",), ("8",), None),
        ("new", ("5",), None, None), ("new", ("6",), None, None), (None, ("7",), ("7",), 1), ("r2", None, None, 9),
    ]
    reviews = spark.createDataFrame(rows, f"receipt_text string, predicted {kind}, corrected {kind}, version int")
    got = sorted((r.input or "", r.output, r.reviewed) for r in review.extend_training(records, reviews).collect())
    assert got == [("", "old", False), ("new", '{"total":"6"}', True)] + [("r1", '{"total":"4"}', True)] * 2 + [("r2", "old", False)]
    assert review.extend_training(records, reviews.where("false")).count() == 4
    assert review.extend_training(records.where("false"), reviews).count() == 2
