"""Removal of long repeated word spans by suffix automata.

A window is ``size`` consecutive words; a word goes if a window that covers it also starts in a
document with a smaller id. Broadcasting automata of the whole corpus to every document would be
quadratic, so the reference is sharded by content: each window belongs to the anchor (the least
hash of its inner word grams), and equal windows have equal anchors. Runs of windows with one
anchor are segments.

1. Of equal texts only the one with the smallest id goes on; the others lose every window.
2. Anchors that only one document has are dropped: one pass counts them as bare numbers, the next leaves the
   rest out by a broadcast bit filter of a fixed size (16 MB; where it fills up it lets more through, and the
   join behind it is exact).
3. An anchor with a single segment needs no text: its first document is known.
4. The distinct segments of any other anchor form a reference shard: a generalised suffix automaton
   whose states hold the smallest document id. The segments stream through it, and their matching
   statistics give, per window, the first document that holds it.
5. An anchor with more than ``SPLIT`` distinct segments has no shard: the first document of each of its
   windows is a minimum by the window's hash, combined before the shuffle, so that no list grows with
   the corpus, however many surroundings a passage has.

Null or wordless text has no words. Equal rows keep the words of the row with the smaller id; rows
with one id don't cut each other, and rows without an id neither cut nor are cut. Texts that lose nothing keep
their white space. An empty table gives an empty result. Other columns are only read when named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import Tables, bit_filter, gram_hashes, hashes_of_texts, map_frames, passes, words

INNER, SPLIT = 5, 1_000
ROWS = 64  # texts whose hashes a worker holds at a time


def segments(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, first window, number of windows and digest of every segment of a text with these word hashes."""
    if len(hashes) < size:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    inner = min(INNER, size)
    grams = gram_hashes(hashes, inner)
    span = size - inner + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(len(grams) - span + 1)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    counts = np.diff(np.r_[starts, len(at)])
    # the first and the last window overlap and cover the segment
    whole = gram_hashes(hashes, size)
    digest = (whole[starts] * np.uint64(0x9E3779B97F4A7C15) + whole[starts + counts - 1]) * np.uint64(0x94D049BB133111EB) + counts.astype(np.uint64)
    return grams[at[starts]].view(np.int64), starts, counts, digest.view(np.int64)


class SuffixAutomaton:
    """Generalised suffix automaton over words; each state knows the smallest document of its factors."""

    def __init__(self):
        self.edges: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [np.iinfo(np.int64).max]

    def _state(self, edges: dict, link: int, length: int, first: int) -> int:
        self.edges.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.edges) - 1

    def _split(self, at: int, symbol, onto: int) -> int:
        twin = self._state(dict(self.edges[onto]), self.link[onto], self.length[at] + 1, self.first[onto])
        self.link[onto] = twin
        while at != -1 and self.edges[at].get(symbol) == onto:
            self.edges[at][symbol] = twin
            at = self.link[at]
        return twin

    def add(self, symbols: list, document: int) -> None:
        last = 0
        for symbol in symbols:
            onto = self.edges[last].get(symbol)
            if onto is not None:
                last = onto if self.length[onto] == self.length[last] + 1 else self._split(last, symbol, onto)
            else:
                new, at = self._state({}, 0, self.length[last] + 1, document), last
                while at != -1 and symbol not in self.edges[at]:
                    self.edges[at][symbol] = new
                    at = self.link[at]
                if at != -1:
                    onto = self.edges[at][symbol]
                    self.link[new] = onto if self.length[onto] == self.length[at] + 1 else self._split(at, symbol, onto)
                last = new
            self.first[last] = min(self.first[last], document)

    def finish(self) -> None:
        for state in sorted(range(1, len(self.edges)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            self.first[up] = min(self.first[up], self.first[state])

    def first_documents(self, symbols: list, size: int) -> list[int]:
        """Matching statistics of a text; for every place matched over ``size`` symbols, the first document."""
        state, matched, out = 0, 0, []
        for symbol in symbols:
            while state and symbol not in self.edges[state]:
                state = self.link[state]
                matched = self.length[state]
            if symbol in self.edges[state]:
                state, matched = self.edges[state][symbol], matched + 1
            while matched > size and self.length[self.link[state]] >= size:
                state = self.link[state]
                matched = self.length[state]
            if matched >= size:
                out.append(self.first[state])
        return out


def repeated_windows(docs: DataFrame, size: int = 13, split: int = SPLIT, shared: Tables | None = None, held: tuple[DataFrame, ...] = ()) -> DataFrame:
    """doc_id, windows: the places of the windows that a document with a smaller id holds too.

    ``docs`` has no two documents with one text; it is read three times. Tables of ``shared`` that are not
    needed any more go, but for those in ``held``."""
    shared = shared or Tables(docs.sparkSession)

    def once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                found = [np.unique(segments(h, size)[0]) for h in hashes_of_texts(list(batch["text"].iloc[at : at + ROWS]))]
                yield pd.DataFrame({"anchor": np.concatenate(found)})

    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at : at + ROWS]
                found = [segments(h, size) for h in hashes_of_texts(list(part["text"]))]
                anchor, start, n, digest = (np.concatenate(x) for x in zip(*found))
                rows = {"doc_id": np.repeat(part["doc_id"].to_numpy(), [len(f[0]) for f in found]), "anchor": anchor, "start": start, "n": n, "digest": digest}
                kept = passes(bits.value, anchor)
                yield pd.DataFrame({name: column[kept] for name, column in rows.items()})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                rows, part = [], batch.iloc[at : at + ROWS]
                for doc, text, places in zip(part["doc_id"], part["text"], part["places"]):
                    tokens = words(text)
                    hashes = gram_hashes(hashes_of_texts([text])[0], size).view(np.int64) if any(p["hot"] for p in places) else None
                    for p in places:
                        start, n = p["start"], p["n"]
                        if p["hot"]:
                            rows += [(p["anchor"], hashes[start + k], p["digest"], k, None, doc) for k in range(n)]
                        else:
                            rows.append((p["anchor"], 0, p["digest"], 0, " ".join(tokens[start : start + n + size - 1]), doc))
                yield pd.DataFrame(rows, columns=["anchor", "window", "digest", "shift", "segment", "first"])

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(key, group):
            automaton = SuffixAutomaton()
            parts = [(digest, segment.split(" "), first) for digest, segment, first in group]
            known = {}
            for _, symbols, first in parts:
                at = tuple(symbols)
                if known.get(at, first + 1) > first:
                    automaton.add(symbols, first)
                    known[at] = first
            automaton.finish()
            return [(key, digest, 0, automaton.first_documents(symbols, size)) for digest, symbols, _ in parts]

        current, group = None, []
        for batch in batches:
            rows = []
            for anchor, digest, segment, first in batch.itertuples(index=False):
                if group and anchor != current:
                    rows += solve(current, group)
                    group = []
                current = anchor
                group.append((digest, segment, first))
            yield pd.DataFrame(rows, columns=["anchor", "digest", "shift", "firsts"])
        if group:
            yield pd.DataFrame(solve(current, group), columns=["anchor", "digest", "shift", "firsts"])

    texts = docs.select("doc_id", "text").filter("doc_id is not null")
    again = shared(map_frames(texts, once, "anchor long").groupBy("anchor").count().filter("count > 1").select("anchor"))
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(again.select("anchor")))
    found = map_frames(texts, anchors, "doc_id long, anchor long, start int, n int, digest long")
    found = shared(found.join(again, "anchor", "left_semi"))
    every = shared(found.groupBy("anchor", "digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")))
    kinds = every.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("low").alias("least"), F.max("high").alias("most")).filter("least < most")
    distinct = shared(every.join(kinds.select("anchor", "kinds"), "anchor").select("anchor", "digest", "low", "kinds"))
    met = shared(found.join(distinct, ["anchor", "digest"]))
    shared.drop(met, docs, *held)
    told = met.filter("kinds = 1 and low < doc_id").select("doc_id", F.expr("sequence(start, start + n - 1)").alias("windows"))

    asked = met.filter("kinds > 1")
    shown = asked.filter("doc_id = low").groupBy("doc_id", "anchor", "digest").agg(F.min("start").alias("start"), F.max("n").alias("n"), (F.max("kinds") > split).alias("hot"))
    places = shown.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "digest", "start", "n", "hot")).alias("places"))
    pieces = shared(map_frames(texts.join(places, "doc_id"), cut, "anchor long, window long, digest long, shift int, segment string, first long"))
    dealt = pieces.filter("segment is not null").select("anchor", "digest", "segment", "first").repartition("anchor").sortWithinPartitions("anchor", "first", "digest")
    solved = dealt.mapInPandas(shard, "anchor long, digest long, shift int, firsts array<long>")
    windows = pieces.filter("segment is null")
    least = windows.groupBy("anchor", "window").agg(F.min("first").alias("least"))
    # no sort-merge buffer holds a hot window: the side of the minima has one row for each
    lone = windows.join(least, ["anchor", "window"]).select("anchor", "digest", "shift", F.array("least").alias("firsts"))
    firsts = shared(solved.union(lone))
    hits = asked.select("anchor", "digest", "doc_id", "start").join(firsts, ["anchor", "digest"])
    hits = hits.select("doc_id", F.expr("transform(filter(sequence(0, size(firsts) - 1), k -> firsts[k] < doc_id), k -> k + start + shift)").alias("windows"))
    return told.union(hits.filter("size(windows) > 0")).groupBy("doc_id").agg(F.flatten(F.collect_list("windows")).alias("windows"))


def remove_repeats(docs: DataFrame, size: int = 13, carry: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``kept`` (the text left), n_words and n_removed, and the columns named in ``carry``."""
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    shared = Tables(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.md5(F.encode("text", "UTF-8")).alias("sum"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    ids = rows.select("doc_id", "sum")
    low = shared(ids.groupBy("sum").agg(F.min("doc_id").alias("low")))
    firsts = rows.select("doc_id", "text", "sum").join(low.select(F.col("low").alias("doc_id"), "sum"), ["doc_id", "sum"], "left_semi")
    firsts = shared(firsts.dropDuplicates(["doc_id", "sum"]))
    hits = shared(repeated_windows(firsts, size, shared=shared, held=(low,)))
    # what happens to a row is found on ids alone, so that texts move once more
    copies = ids.join(low, "sum").filter("low < doc_id").groupBy("doc_id").agg(F.collect_set("sum").alias("copied"))
    told = shared(hits.join(copies, "doc_id", "full"))
    shared.drop(told)
    marked = rows.join(told, "doc_id", "left").withColumn("copy", F.coalesce(F.array_contains("copied", F.col("sum")), F.lit(False))).drop("copied", "sum")

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, copy, windows in zip(batch["doc_id"], batch["text"], batch["copy"], batch["windows"]):
                tokens = words(text)
                gone = np.zeros(len(tokens) + 1, np.int64)
                at = np.arange(max(0, len(tokens) - size + 1)) if copy is not None and copy else np.unique(np.asarray(windows, np.int64)) if windows is not None else ()
                if len(at):
                    np.add.at(gone, at, 1)
                    np.add.at(gone, np.minimum(at + size, len(tokens)), -1)
                drop = np.cumsum(gone)[:-1] > 0
                left = [t for t, d in zip(tokens, drop) if not d] if drop.any() else tokens
                joined = " ".join(left)
                out.append((doc, text if not drop.any() else joined, hashlib.sha256(joined.encode()).hexdigest(), len(tokens), int(drop.sum())))
            frame = pd.DataFrame(out, columns=["doc_id", "kept", "kept_sha256", "n_words", "n_removed"], dtype=object)
            for name in carry:
                frame[name] = batch[f"carry_{name}"].to_numpy()
            yield frame

    carried = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    return map_frames(marked, remove, f"doc_id {kind}, kept string, kept_sha256 string, n_words long, n_removed long{carried}")
