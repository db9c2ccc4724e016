"""What the two classifiers share: the bounded sample of labelled rows and the training task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import map_frames


def held_out(modulus: int, remainder: int):
    """Whether the checksum of the id leaves this remainder; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, train, rows: int) -> DataFrame:
    """At most ``rows`` labelled training texts, half of each label, picked by a hash of the id.

    A repeated row gives one text (of rows that share an id the least), conflicting labels the larger one;
    labels other than 0 and 1, and ids of one table alone, are left out."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(train & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.xxhash64("doc_id", F.lit(label))
    picked = [known.filter(F.col("y") == y).orderBy(order, "doc_id").limit(rows // 2) for y in (0, 1)]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = texts.join(F.broadcast(picked[0].union(picked[1])), "doc_id")  # at most ``rows`` ids
    return known.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def fit_in_task(rows: DataFrame, fit: Callable[[list[str], list[int]], object]):
    """Fits on the bounded sample in one task and brings the model (a few MB) to the driver."""

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "y": []}), *batches]).sort_values(["doc_id", "text"])
        yield pd.DataFrame({"model": [pickle.dumps(fit(list(whole["text"]), [int(y) for y in whole["y"]]))]})

    trained = rows.repartition(1).mapInPandas(train, "model binary").first()
    # An empty table of labels lets Spark leave the task out.
    return pickle.loads(bytes(trained["model"])) if trained is not None else fit([], [])


def scored(docs: DataFrame, model, score: Callable[[object, list[str | None]], list[float]], test, owner: str = "") -> DataFrame:
    """doc_id, held_out, score, predicted of every row, map-side."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                values = score(sent.value, [t or "" for t in part["text"]])
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "score": values})

    found = map_frames(docs.select("doc_id", "text"), rows, "doc_id long, score double", owner)
    return found.select("doc_id", test.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
