"""What the block plan leaves on the disk: coordinates while it looks, one table of links at the end."""

import os
import random

import pytest

from docsift.operators import layout
from docsift.operators.stored import drop_stored, shared_folder, stored

from test_layout import SCHEMA, brute


def tables(spark):
    top = shared_folder(spark).removeprefix("file://")
    return {name for name in os.listdir(top) if name.startswith("table-")}


@pytest.mark.parametrize("hot", [False, True])
def test_tables_of_finished_steps_are_deleted(spark, monkeypatch, hot):
    """All tables stayed, with the answers of all centres, until the result was written."""
    shared_folder(spark)
    rng = random.Random(6)
    span = 40 if hot else 4000
    rows = [(rng.choice("ab"), f"{i:09d}", f"t{i}", ("QUESTION", "ANSWER")[i % 2], [rng.randrange(span), rng.randrange(span)] * 2, 0.9) for i in range(600)]
    rows += [(f"d{i % 9}", f"{i:09d}", f"t{i}", ("QUESTION", "ANSWER")[i % 2], [i, i + 3] * 2, 0.9) for i in range(60)]
    tokens = spark.createDataFrame(rows, SCHEMA.replace("token_pos int", "token_pos string"))
    for name, value in (("BLOCK_ANSWERS", 20), ("BLOCK_QUESTIONS", 30), *([("HOT_QUESTIONS", 2)] if hot else [])):
        monkeypatch.setattr(layout, name, value)
    before = tables(spark)
    links = layout.link_boxes(tokens, 10)
    read = {f.split("/")[-2] for f in links.inputFiles()}
    left = tables(spark) - before
    wide = [t for t in left if "question" in spark.read.parquet(f"{shared_folder(spark)}/{t}").columns]
    large = [t for t in left - read if {"qx", "x"} & set(spark.read.parquet(f"{shared_folder(spark)}/{t}").columns)]
    assert not large and len(wide) == 1
    assert {(r.doc_id, r.question_pos): r.answer_pos for r in links.collect()} == brute(rows)


def test_only_stored_tables_are_dropped(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/mine")
    kept, gone = spark.read.parquet(f"{tmp_path}/mine"), stored(spark.range(3))
    before = tables(spark)
    drop_stored(kept, gone)
    assert len(before - tables(spark)) == 1 and kept.count() == 3


def test_centre_without_a_position_has_no_answer(spark):
    rows = [("a", None, "x", "ANSWER", [0, 0, 0, 0], 0.9), ("a", 4, "y", "ANSWER", [5, 5, 5, 5], 0.9), ("a", 3, "z", "ANSWER", [5, 5, 5, 5], 0.8), ("a", None, "n", "ANSWER", [5, 5, 5, 5], 0.8)]
    answers = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "box[0] as x", "box[1] as y")
    got = {r.x: (r.token_pos, r.answer and r.answer.text) for r in layout._centres(answers).collect()}
    assert got == {0: (None, None), 5: (3, "z")}
