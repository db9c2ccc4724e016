"""Tokens of whole texts by a two-tier map-side lookup of pre-tokens.

Tier one is a broadcast table of frequent pre-tokens (at most ``TABLE`` entries, so a few MB);
tier two is a cache in each worker (emptied at ``CACHE`` entries). Only a miss of both is encoded
by the library. Texts never leave their partition; to find the frequent pre-tokens each task
passes on at most ``SUMMARY`` counts of its own. Null text counts as empty (0 tokens); a text
that holds a special string, or a character for which the pattern below might differ from the
library's, is encoded whole by the library. Repeated rows and null ids are counted like any others, and
equally frequent pre-tokens enter the table in the order of their text, which no count depends on. Other
columns are only kept when named; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import kept_by_worker, map_frames

TABLE, SUMMARY, CACHE = 16_384, 1_024, 600_000
#: Fixed value: the pre-tokenizing pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Up to here the classes of the pattern agree with the library on every code point (tested).
PLAIN = r"[^\x00-\u0500\u2010-\u2030\u20ac]"


def plain_pattern() -> str:
    """``PATTERN`` for plain texts: its classes spelled out over their code points, which ``re`` splits in half the time."""
    import regex

    plain = [c for c in map(chr, [*range(0x501), *range(0x2010, 0x2031), 0x20AC])]
    letter, number, space = ("".join(re.escape(c) for c in plain if regex.fullmatch(kind, c)) for kind in (r"\p{L}", r"\p{N}", r"\s"))
    return rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


class PreTokens:
    """Splits texts and looks up the ids of each pre-token, as little-endian 32-bit bytes."""

    def __init__(self, path: str, table: dict[str, bytes] | None = None):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.many = getattr(self.library, "encode_batch_fast", self.library.encode_batch)
        self.split = re.compile(plain_pattern()).findall
        self.odd = re.compile(PLAIN).search
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.table, self.cache = table or {}, {}
        vocabulary = self.library.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for content, number in vocabulary.items():  # a character of the byte-level vocabulary is a byte
            self.n_bytes[number] = len(content)

    def encode(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def pieces(self, text: str | None) -> list[bytes]:
        """The ids of a whole text, one entry per pre-token."""
        if not text:
            return []
        if self.odd(text) or any(s in text for s in self.special):
            return [self.encode(text)]
        tokens = self.split(text)
        if not self.table:
            self.learn(tokens)
            return list(map(self.cache.__getitem__, tokens))
        ids = list(map(self.table.get, tokens))
        rest = [token for token, known in zip(tokens, ids) if known is None]
        self.learn(rest)
        left = map(self.cache.__getitem__, rest)
        return [next(left) if known is None else known for known in ids]

    def learn(self, tokens: Iterable[str]) -> None:
        """Encodes the tokens that the cache lacks as the words of one text, and cuts its ids where the bytes of a word end."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        missing = list(set(tokens).difference(self.cache))
        if missing:
            ids = np.array(self.many([missing], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
            ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum([len(token.encode()) for token in missing])) + 1
            raw, edges = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.cache.update((token, raw[a:b]) for token, a, b in zip(missing, edges, edges[1:]))


def in_worker(path: str, table: dict[str, bytes] | None = None) -> PreTokens:
    """The splitter of this Python worker: its cache outlives a task, so a later task of the worker finds it filled."""
    kept = kept_by_worker("tokens")
    own = kept.get(path) or kept.setdefault(path, PreTokens(path))
    own.table = table or {}
    return own


def frequent(docs: DataFrame, path: str, text: str = "text") -> dict[str, bytes]:
    """Ids of the most frequent pre-tokens of all texts, from bounded summaries of every task."""

    def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, counts = in_worker(path), Counter()
        for batch in batches:
            for value in batch[text]:
                if value and not own.odd(value):
                    counts.update(own.split(value))
                    if len(counts) > 64 * SUMMARY:
                        counts = Counter(dict(counts.most_common(16 * SUMMARY)))
        top = counts.most_common(SUMMARY)
        yield pd.DataFrame({"token": [t for t, _ in top], "n": [n for _, n in top]}, dtype=object)

    tops = map_frames(docs.select(text), summaries, "token string, n long", "tokens").groupBy("token").agg(F.sum("n").alias("n"))
    rows = tops.orderBy(F.desc("n"), "token").limit(TABLE).collect()
    own = PreTokens(path)
    return {r.token: own.encode(r.token) for r in rows}


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_bytes (UTF-8) and n_tokens of every row; repeated rows are counted again."""
    session = docs.sparkSession
    lookup = session.sparkContext.broadcast(frequent(docs, path, text))

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = in_worker(path, lookup.value)
        for batch in batches:
            batch["n_bytes"] = [len(t.encode()) if t else 0 for t in batch[text]]
            batch["n_tokens"] = [sum(map(len, own.pieces(t))) // 4 for t in batch[text]]
            yield batch.drop(columns=[text])

    picked = docs.select(*keep, text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", n_bytes long, n_tokens long"
    return map_frames(picked, counts, schema, "tokens")
