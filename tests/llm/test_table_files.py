"""Intermediate tables of few rows are few files, however many partitions a shuffle has."""

import os

from test_shared_passage_join import components

from docsift.llm import ngram_join
from docsift.llm.common import Tables, dealt_by_rows, shared_folder


def test_tables_of_the_join_are_few_files(spark, monkeypatch):
    shared_folder(spark)
    wrote = []

    class Counted(Tables):
        def __call__(self, *args):
            table = super().__call__(*args)
            folder = list(self.open)[-1].removeprefix("file://")
            wrote.append(sum(name.startswith("part-") for name in os.listdir(folder)))
            return table

    monkeypatch.setattr(ngram_join, "Tables", Counted)
    texts = [" ".join([f"g{i % 40}w{j}" for j in range(40)] + [f"own{i}"] * (i % 3)) for i in range(160)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    held = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "20")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        result = ngram_join.join_components(docs)
        parts = result.rdd.getNumPartitions()
        got = {r.doc_id: r.component_id for r in result.collect()}
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    assert got == dict(enumerate(components(texts, 4, 85))) and len(set(got.values())) == 40
    # Whole prefixes are written by the tasks that read the texts, pairs of the last round by their shuffle.
    assert parts == 1 and len(wrote) > 20 and sorted(wrote)[-2:][0] <= 2 and sum(wrote) <= len(wrote) + 21


def test_rows_are_dealt_to_as_many_partitions_as_they_are_worth(spark):
    rows = spark.range(0, 900, 1, 30)
    assert dealt_by_rows(rows, 900).rdd.getNumPartitions() == 1
    assert dealt_by_rows(rows, 250_000).rdd.getNumPartitions() == 3
    assert dealt_by_rows(rows, 10**9).rdd.getNumPartitions() == 30 and dealt_by_rows(rows, 900).count() == 900
