"""Resampling towards a target distribution by importance weights over hashed n-grams.

A text is lower-cased and blanked at separators by one 256-byte table over its UTF-8, ``bytes.split`` gives
the words, and the CRC-32 of a run of words goes on from the CRC-32 of the run before it. Counters of the
buckets are kept per task and summed before the shuffle: at most ``BUCKETS`` rows leave a task, and the
gains, one per bucket, are the only thing that passes through the driver.

A document's weight is the sum of the gains of its features; with Gumbel noise from a hash of its id, the
highest scores are a draw without replacement. Ranks are positions over ranges of the scores.

A null text has no words. A null id is drawn with an empty id and precedes the others at ties; rows with one
id and one score are ranked by features and weight. Repeated rows are rows of their own. With an empty table
of documents the result is empty; with an empty target all t are 0. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators.order import RANGE_ROWS, global_index
from docsift.operators.stored import stored

BUCKETS = 10_000
SIZES = 3
SHARE = (5, 100)
MIN_WORDS = 20
SEED = 42
#: Lower-cases A-Z, keeps a-z, 0-9 and all bytes of other scripts, blanks the rest.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def features(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``SIZES`` words."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()
    runs = list(map(crc32, found))
    all_runs, following = list(runs), [b" " + w for w in found]
    for size in range(1, SIZES):
        runs = list(map(crc32, following[size:], runs))
        all_runs += runs
    return len(found), np.array(all_runs, np.int64) % BUCKETS


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """bucket, n over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(features(value.as_py())[1].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["bucket", "n"])

    return texts.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: dict[int, int], target: dict[int, int]) -> list[int]:
    """Thousandths of the log ratio of target to raw share, per bucket, with one added to every count."""
    all_raw, all_target = float(sum(raw.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    return [
        math.floor(1000 * math.log((target.get(b, 0) + 1.0) * all_raw / ((raw.get(b, 0) + 1.0) * all_target)))
        for b in range(BUCKETS)
    ]


def noise(doc_id: int | None) -> int:
    """Thousandths of a standard Gumbel value from a hash of the id."""
    drawn = int(hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def weigh(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of ``docs``."""
    sums = [{r.bucket: r.n for r in bucket_counts(texts).collect()} for texts in (docs, target)]  # at most BUCKETS rows each
    sent = docs.sparkSession.sparkContext.broadcast(np.array(gains(*sums), np.int64))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [(n, b.size, int(sent.value[b].sum())) for n, b in (features(t.as_py()) for t in batch.column(1))]
            n_words, n_features, weight = ([f[i] for f in found] for i in range(3))
            score = [w + noise(i) for w, i in zip(weight, ids)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight, score))],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_features, weight, score, rank, n_words of every row; the drawn ones have a rank from 1."""
    weighed = stored(weigh(docs, target))
    long_enough = F.col("n_words") >= min_words
    ranked = global_index(
        weighed.where(long_enough), [F.desc("score"), "doc_id", "n_features", "weight"], "place", total="n_long", range_rows=range_rows
    )
    drawn = F.expr(f"n_long * {SHARE[0]} div {SHARE[1]}")
    ranked = ranked.withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1)).drop("place", "n_long")
    rest = weighed.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
