"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, lowered. Seeds of ``least`` words that a document shares with
an item are found by hash, then tiled: the longest non-overlapping match over words not yet marked
is marked, again and again (running Karp-Rabin), whatever the order of the passages. An item
covered to ``threshold`` or more is contaminated. The benchmark is read in blocks of bounded size;
each block meets all documents in one map-side pass, so nothing grows with the benchmark.
Null and empty texts have no words and match nothing; items shorter than ``least`` words are one seed.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from docsift.llm.common import gram_hashes, map_frames, word_hashes

TOKEN = re.compile(r"[^\W_]+")
BLOCK_CHARS = 8_000_000
RESULT = "doc_id long, item_id long, covered long, item_words long, coverage double, tiles array<struct<doc_start:int,item_start:int,length:int>>"


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def tile(doc: list[str], item: list[str], seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in doc, place in item, length), longest first; ties go to the earlier place."""
    used_doc: set[int] = set()
    used_item: set[int] = set()
    tiles, open_ = [], seeds
    while open_:
        best, left = (0, 0, 0), []
        for i, j in open_:
            size = 0
            while i + size < len(doc) and j + size < len(item) and doc[i + size] == item[j + size] and i + size not in used_doc and j + size not in used_item:
                size += 1
            if size >= least:
                left.append((i, j))
                best = max(best, (size, -i, -j))
        if not best[0]:
            break
        size, i, j = best[0], -best[1], -best[2]
        tiles.append((i, j, size))
        used_doc.update(range(i, i + size))
        used_item.update(range(j, j + size))
        open_ = left
    return tiles


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, chars = [], 0
    for row in benchmark.select("item_id", "text").dropna().orderBy("item_id").toLocalIterator():
        block.append((row.item_id, row.text))
        chars += len(row.text)
        if chars > BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, least: int = 5) -> DataFrame:
    """One row per document and item that it covers to the threshold."""
    session = docs.sparkSession
    texts = docs.select("doc_id", "text")
    parts = [_against(texts, session.sparkContext.broadcast(block), threshold, least) for block in _blocks(benchmark)]
    return functools.reduce(DataFrame.unionByName, parts) if parts else session.createDataFrame([], RESULT)


def _against(texts: DataFrame, block, threshold: float, least: int) -> DataFrame:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = [(i, tokens_of(t)) for i, t in block.value]
        sizes = sorted({min(least, len(t)) for _, t in items if t})
        index: dict[int, dict[int, list]] = {s: {} for s in sizes}
        for k, (_, t) in enumerate(items):
            if t:
                size = min(least, len(t))
                for j, h in enumerate(gram_hashes(word_hashes(t), size).tolist()):
                    index[size].setdefault(h, []).append((k, j))
        known = {s: np.sort(np.fromiter(x, np.uint64, len(x))) for s, x in index.items()}
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                own = tokens_of(text)
                hashes, hits = word_hashes(own), {}
                for size in sizes:
                    grams = gram_hashes(hashes, size)
                    if not len(grams):
                        continue
                    near = np.minimum(np.searchsorted(known[size], grams), len(known[size]) - 1)
                    for i in np.flatnonzero(known[size][near] == grams).tolist():
                        for k, j in index[size][int(grams[i])]:
                            hits.setdefault(k, []).append((i, j))
                for k, seeds in hits.items():
                    item_id, item = items[k]
                    size = min(least, len(item))
                    tiles = tile(own, item, seeds, size)
                    covered = sum(t[2] for t in tiles)
                    if covered >= threshold * len(item):
                        rows.append((doc, item_id, covered, len(item), covered / len(item), [dict(doc_start=a, item_start=b, length=c) for a, b, c in tiles]))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "covered", "item_words", "coverage", "tiles"], dtype=object)

    return map_frames(texts, scan, RESULT)
