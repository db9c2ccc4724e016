"""Small helpers of the operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.operators.stored import shared_folder  # noqa: F401 - the pipeline names its tables with it
from docsift.operators.stored import stored as shared  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def ascii_lower(text: str | None) -> str:
    return text.translate(_LOWER) if text else ""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a task and file where the number of rows is known.
FILE_ROWS = 100_000


def dealt_by_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` small rows, in no more partitions than they are worth."""
    return df.coalesce(1 + rows // FILE_ROWS)


class Tables:
    """Intermediate tables of one operator in the shared folder.

    Writing one ends the shuffles behind it; their files go when the driver collects its garbage, which
    is asked for here, as a long chain of tables would else hold the shuffles of all its steps. ``drop``
    removes the tables that the result doesn't read.

    A caller that knows how many ``rows`` can come at most gets a file per ``FILE_ROWS`` of them, and not one per
    partition of a shuffle: on a local disk Hadoop starts three processes (chmod) for each file, and each
    counts as large as its executor until its program is loaded.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.open = spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}", {}

    def __call__(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        path = f"{self.folder}/{len(self.open)}"
        (df if rows is None else dealt_by_rows(df, rows)).write.parquet(path)
        table_ = self.spark.read.schema(df.schema).parquet(path)
        self.open[path] = table_
        self.spark.sparkContext._jvm.System.gc()
        return table_

    def drop(self, *kept: DataFrame) -> None:
        path_of = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path, table_ in self.open.items():
            if table_ is not None and not any(table_ is k for k in kept):
                gone = path_of(path)
                gone.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(gone, True)
                self.open[path] = None


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    return df.sparkSession.createDataFrame([], schema).toArrow().schema


def _in_arrow(frame: pd.DataFrame, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)


#: Rows of a frame: a worker holds the texts of a batch (10,000 rows by Spark's default) once, and not as Python strings as well.
FRAME_ROWS = 1_024

_KEPT: dict[str, dict] = {}


def kept_by_worker(owner: str) -> dict:
    """What this Python worker keeps from task to task for one operator. A worker serves many operators, one at a time:
    the caches of the others go."""
    if owner not in _KEPT:
        _KEPT.clear()
        _KEPT[owner] = {}
    return _KEPT[owner]


def map_frames(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, owner: str = "") -> DataFrame:
    """``mapInPandas`` that keeps whole numbers exact beside nulls: such columns come as objects, ids above 2**53 included.

    A result with nulls among its whole numbers has to be of objects as well. Frames have at most ``FRAME_ROWS`` rows.
    ``owner`` names the operator whose caches (``kept_by_worker``) are read; without one none stay."""
    kinds = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by_worker(owner)
        parts = (batch.slice(at, FRAME_ROWS) for batch in batches for at in range(0, max(1, batch.num_rows), FRAME_ROWS))
        for frame in fn(part.to_pandas(integer_object_nulls=True) for part in parts):
            yield _in_arrow(frame, kinds)

    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``applyInPandas`` with the same care; the groups must be of bounded size."""
    kinds = _arrow_schema(df, schema)

    def run(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_in_arrow(fn(group.to_pandas(integer_object_nulls=True)), kinds)], kinds)

    return df.groupBy(*keys).applyInArrow(run, schema)


def word_hashes(tokens: list[str]) -> np.ndarray:
    """A 64-bit hash per word, the same in every process."""
    from xxhash import xxh64_intdigest

    seen: dict[str, int] = {}
    return np.fromiter((seen[t] if t in seen else seen.setdefault(t, xxh64_intdigest(t.encode("utf-8", "surrogatepass"))) for t in tokens), np.uint64, len(tokens))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin value (modulo 2**64, mixed at the end) of every run of ``size`` hashes."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    value = np.zeros(count, np.uint64)
    for at in range(size):
        value = value * _MULTIPLIER + hashes[at : at + count]
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


_STEP = 0x5851F42D4C957F2D
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(97).integers(0, 2**64, 256, np.uint64)
_LOWERED = _BYTES[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]


def hashes_of_texts(texts: list[str | None], lower: bool = False) -> list[np.ndarray]:
    """A 64-bit hash per word of every text, the same in every process; ``lower`` takes A-Z as a-z.

    White space is ASCII, so words are cut and hashed on the UTF-8 bytes: a polynomial over random
    values of the bytes (modulo 2**64), by differences of running sums over all texts at once."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    ends = np.cumsum([len(e) for e in encoded])
    space = np.r_[True, _SPACE[data]]
    edges = np.flatnonzero(space[1:] != space[:-1])
    begin, end = edges[::2], edges[1::2]
    powers = np.multiply.accumulate(np.full(len(data) + 1, _STEP, np.uint64))
    sums = np.r_[np.uint64(0), np.cumsum((_LOWERED if lower else _BYTES)[data] * powers[1:], dtype=np.uint64)]
    back = np.multiply.accumulate(np.full(len(data) + 1, pow(_STEP, -1, 2**64), np.uint64))
    value = (sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64)
    value ^= value >> np.uint64(32)
    value *= _MULTIPLIER
    value ^= value >> np.uint64(29)
    return np.split(value, np.searchsorted(begin, ends[:-1]))


#: Bits of a filter that tells most of what is not in a set; 16 MB whatever the set's size.
BITS = 1 << 27


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places in the bit filter; the hashes are mixed already."""
    bits = hashes.view(np.uint64)
    return bits & np.uint64(BITS - 1), (bits >> np.uint64(32)) & np.uint64(BITS - 1)


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """Words of a bit filter that holds all hashes (a column of longs); at most ``BITS / 64`` rows reach the driver."""
    (name,) = hashes.columns
    places = F.explode(F.array(F.col(name).bitwiseAND(F.lit(BITS - 1)), F.shiftrightunsigned(name, 32).bitwiseAND(F.lit(BITS - 1))))
    words_ = hashes.select(places.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
    found = words_.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    first, second = _slots(hashes)
    return ((bits[first >> np.uint64(6)] >> (first & np.uint64(63))) & (bits[second >> np.uint64(6)] >> (second & np.uint64(63))) & np.uint64(1)) > 0
