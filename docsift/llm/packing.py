"""Packing of tokenised documents into sequences by first-fit decreasing.

A document's ids are cut into full pieces, each a sequence of its own, and one rest. The rests of
a randomised group of documents (a hash of the document id, so a retry gives the same group) are
placed by first-fit decreasing; a tournament tree over the free room of the bins finds the first
fit in a logarithm of the group's size. Groups hold about ``group_rows`` documents whatever the
table's size. Null text is empty and gives the closing id alone; empty tables give no pieces;
repeated rows are packed again, each for itself. Null ids are one group and come first in it; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import map_frames, map_groups
from docsift.llm.token_counts import in_worker

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; equal sizes keep their order."""
    count = len(sizes)
    leaves = 1 << max(0, count - 1).bit_length()
    tree = [room] * (2 * leaves)
    bins, offsets = np.zeros(count, np.int64), np.zeros(count, np.int64)
    for item in np.argsort(-sizes, kind="stable"):
        size, node = int(sizes[item]), 1
        while node < leaves:
            node = 2 * node if tree[2 * node] >= size else 2 * node + 1
        bins[item], offsets[item] = node - leaves, room - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins, offsets


def cut(docs: DataFrame, path: str, room: int = 1024, closing: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: all of ``room`` ids but the last."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = in_worker(path), np.array([closing], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                raw = b"".join(own.pieces(text)) + end
                for at in range(0, len(raw), 4 * room):
                    part = raw[at : at + 4 * room]
                    ids = np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None
                    rows.append((doc, at // 4, len(part) // 4, zlib.crc32(part), len(raw) // 4, ids))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"], dtype=object)

    return map_frames(docs.select("doc_id", "text"), pieces, PIECES, "tokens")


def pack(docs: DataFrame, path: str, room: int = 1024, closing: int = 0, group_rows: int = 4096, with_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``with_ids`` adds the ids of each piece."""
    groups = max(1, docs.count() // group_rows)
    pieces = cut(docs, path, room, closing, with_ids)
    key = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("packing")), F.lit(groups))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(np.int64), room)
        rows["sequence_id"] = rows["group"].to_numpy() + bins * groups
        rows["offset"] = offsets
        return rows.drop(columns=["group"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>, sequence_id long, offset long"
    placed = map_groups(pieces.withColumn("group", key), ["group"], place, schema)
    return placed if with_ids else placed.drop("ids")
