"""The corpus pipeline: each stage works on what its predecessor kept, written as Parquet in the shared folder.

A stage decides per document by the operator's own result and keeps clean documents as they are. Extra
columns of the documents are left out, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import decontamination, ngram_join, packing, substring_dedup, toxicity
from docsift.llm.common import shared_folder, table
from docsift.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts: all rows of an id go if it rejects one; rows without an id stay."""
    bad = toxicity.classify(docs, table(spark, sf_dir, "labels")).filter("predicted = 1").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every component of links: five words and a similarity of 0.8, unlike the query of op9.

    Repeated rows of that id, rows without an id and texts without words stay."""
    out = ngram_join.join_components(docs.select("doc_id", "text"), size=5, percent=80).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(out, "doc_id", "left_anti").select(*COLUMNS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that an earlier document has; null and untouched texts stay as they are."""
    rows = substring_dedup.remove_repeats(docs, carry=("lang", "source", "n_chars")).withColumnRenamed("kept", "text")
    return rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item; rows without an id stay."""
    bad = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*COLUMNS)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic), ("ngram_join", keep_one_of_each_group), ("substring_dedup", remove_repeats),
    ("decontamination", decontaminate), ("packing", pack_documents),
]
#: The model of the first stage has no SQL; tests compare the stages after it with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for step, (_, stage) in enumerate(STAGES):
        path = f"{base}/{step}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
