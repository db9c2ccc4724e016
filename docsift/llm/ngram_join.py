"""N-gram Jaccard join by vertical partitioning, down to the components of its links.

A document's set holds its distinct shingles of ``size`` words (A-Z lowered); a shorter text is one
shingle; a null or wordless text has an empty set and no link. Two documents link when
``100 * intersection >= percent * union``.

1. One pass gives each document the size of its set and two 64-bit sums of mixed hashes; equal sets
   form a class, and only the class's smallest id goes on. The same pass passes on at most
   ``SUMMARY`` counts a task, from which at most ``HEAVY`` frequent shingles (16 MB) are broadcast.
2. The global order puts these frequent shingles last, by count, and all others before them by
   hash. Any order is right; this one keeps what many texts share, passages or runs of common words, out of the
   prefixes: a prefix shingle that a share of all texts has makes pairs by the square of the corpus. A class leaves
   its task with the prefix of its order only, which any partner must share. Texts do not move: the documents
   wanted are told by a broadcast bit filter of 16 MB, and what it lets pass beside them (copies of a class) changes no result.
3. Prefix shingles of one class alone are dropped (only hashes are shuffled to find them), and of those that the same classes hold (told by a
   128-bit digest) the first in the order stands for all, with their number: a shared passage is one key. Pairs are first built with the most central
   class of each prefix shingle (one pair per member); what these links join is one component.
   Then pairs of different components are built where a shingle can be the first that both share, so
   neither many near copies nor many texts around one passage become all their pairs, and no component is lost.
4. The prefix is the first fragment of the order: its count per pair bounds the whole overlap, and
   pairs below the threshold leave. For the rest, every fragment of the order counts its own
   overlap, and the counts are summed per pair.

Repeated rows and ties are equal sets and share a class; the smallest id stands for them. Ids are
unique but for equal rows; rows that share an id and differ are compared by the least text. A row without
an id is in the component of its equal set, or of none (null) where no row of the class has an id, and
links nothing. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import FILE_ROWS, Tables, bit_filter, dealt_by_rows, gram_hashes, hashes_of_texts, map_frames, passes

FRAGMENTS, PIVOT_ROUNDS, HEAVY, SUMMARY = 4, 2, 1 << 20, 1 << 16
ROWS = 128  # texts whose shingles a worker holds at a time
HELD = 750_000  # shingles that a worker counts at a time, beside KEPT counts; some 50 bytes each
KEPT = 8 * SUMMARY


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    return [np.unique(gram_hashes(h, min(size, len(h))).view(np.int64)) if len(h) else np.zeros(0, np.int64) for h in hashes_of_texts(texts, lower=True)]


def _most_frequent(values: np.ndarray, counts: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return values, counts
    turn = np.argsort(values)
    values = values[turn]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    values, counts = values[starts], np.add.reduceat(counts[turn], starts)
    if len(values) > keep:
        top = np.argpartition(counts, len(counts) - keep)[len(counts) - keep :]
        values, counts = values[top], counts[top]
    return values, counts


def set_digests(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, first and second (the digest of the set) per row; rows with n = -1 are shingles and their counts."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, held, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
        for batch in (whole.iloc[at : at + ROWS] for whole in batches for at in range(0, len(whole), ROWS)):
            found = shingle_sets(list(batch["text"]), size)
            mixed = [f.view(np.uint64) * np.uint64(0x94D049BB133111EB) for f in found]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n": [len(f) for f in found], "first": [int(f.sum()) for f in found],
                "second": [int((m ^ (m >> np.uint64(32))).sum().view(np.int64)) for m in mixed],
            })
            held += found
            waiting += sum(map(len, found))
            if waiting > HELD:
                new, held, waiting = np.concatenate(held), [], 0
                top = _most_frequent(np.r_[top[0], new], np.r_[top[1], np.ones(len(new), np.int64)], KEPT)
        new = np.concatenate([np.zeros(0, np.int64), *held])
        top = _most_frequent(np.r_[top[0], new], np.r_[top[1], np.ones(len(new), np.int64)], SUMMARY)
        often = top[1] > 1
        yield pd.DataFrame({"doc_id": 0, "n": -1, "first": top[0][often], "second": top[1][often]})

    return map_frames(docs.select("doc_id", "text"), digests, "doc_id long, n long, first long, second long")


def frequent(digests: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``HEAVY`` of the most frequent shingles, sorted, and their ranks by count from 1; those of the last count come all or not at all."""
    counted = digests.filter("n < 0").groupBy("first").agg(F.sum("second").alias("n"))
    least, total = None, 0
    for level in sorted(counted.groupBy("n").count().collect(), key=lambda r: -r["n"]):
        total += level["count"]
        if total > HEAVY:
            break
        least = level["n"]
    found = counted.filter(F.lit(False) if least is None else F.col("n") >= least).toArrow()
    shingles, n = (found.column(c).to_numpy() for c in ("first", "n"))
    ranks = np.empty(len(n), np.int32)
    ranks[np.lexsort((shingles, n))] = np.arange(1, len(n) + 1)
    turn = np.argsort(shingles)
    return shingles[turn], ranks[turn]


def in_order(shingles: np.ndarray, heavy: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The set in the global order, and the fragment of each shingle; ``heavy`` has sorted shingles and their ranks."""
    known, ranks = heavy
    rank = np.zeros(len(shingles), np.int64)
    if len(known):
        near = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        rank = np.where(known[near] == shingles, ranks[near], 0)
    turn = np.lexsort((shingles, rank))
    fragment = np.where(rank > 0, FRAGMENTS, (shingles >> 32) // (2**32 // FRAGMENTS) + FRAGMENTS // 2)
    return shingles[turn], fragment[turn]


def least_overlap(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def prefixes(docs: DataFrame, size: int, percent: int, heavy, bits) -> DataFrame:
    """rep, n, position, h: the prefix of every set in the global order, for documents whose mark the filter lets pass."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[passes(bits.value, batch["mark"].to_numpy())]
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at : at + ROWS]
                sets = shingle_sets(list(part["text"]), size)
                n = np.array([len(s) for s in sets], np.int64)
                long = n - (n * percent + 99) // 100 + (n > 0)
                found = [in_order(s, heavy.value)[0][:k] for s, k in zip(sets, long)]
                yield pd.DataFrame({
                    "rep": np.repeat(part["doc_id"].to_numpy(), long), "n": np.repeat(n, long),
                    "position": np.concatenate([np.arange(1, k + 1) for k in long]), "h": np.concatenate(found),
                })

    return map_frames(docs, first, "rep long, n long, position int, h long")


def of_hashes(rows: DataFrame, bits) -> DataFrame:
    """The rows whose h the filter lets pass; most prefix shingles are one text's alone and need no shuffle to be dropped."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(bits.value, batch.column("h").to_numpy())))

    return rows.mapInArrow(kept, rows.schema)


def fragments(docs: DataFrame, size: int, heavy, bits) -> DataFrame:
    """rep, fragment, part: every set cut along the global order, for documents whose mark the filter lets pass."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[passes(bits.value, batch["mark"].to_numpy())]
            for at in range(0, len(batch), ROWS):
                rows = []
                part = batch.iloc[at : at + ROWS]
                for doc, found in zip(part["doc_id"], shingle_sets(list(part["text"]), size)):
                    ordered, fragment = in_order(found, heavy.value)
                    for f in np.unique(fragment):
                        rows.append((doc, int(f), ordered[fragment == f]))
                yield pd.DataFrame(rows, columns=["rep", "fragment", "part"])

    return map_frames(docs, cut, "rep long, fragment int, part array<long>")


def components(edges: DataFrame, keep: Tables) -> DataFrame:
    """node, label (the smallest node reachable) for every node of the edges a, b; each round also jumps over labels."""
    shared, most = Tables(edges.sparkSession), 2 * edges.count()
    both = shared(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), most)
    labels = shared(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), most)
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("low"))
        step = labels.join(near, labels.node == near.a, "left").select("node", F.least("label", "low").alias("next"), "label")
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = shared(step.join(jump, step.next == jump["at"], "left").select("node", F.least("next", "further").alias("label"), F.col("label").alias("before")), most)
        labels = moved.select("node", "label")
        if not moved.filter("label < before").limit(1).count():
            labels = keep(labels, most)
            shared.drop()
            return labels


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs a, b whose overlap, summed over fragments, reaches the threshold."""
    left = parts.select(F.col("rep").alias("a"), "fragment", F.col("part").alias("part_a"))
    right = parts.select(F.col("rep").alias("b"), "fragment", F.col("part").alias("part_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "needed", F.size(F.array_intersect("part_a", "part_b")).alias("common"))
    return partial.groupBy("a", "b", "needed").agg(F.sum("common").alias("common")).filter("common >= needed").select("a", "b")


def least_common(n: Column, m: Column, percent: int) -> Column:
    """The overlap from which sets of these sizes link."""
    return F.floor(((n + m) * percent + 99 + percent) / (100 + percent))


def candidates(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """a, b, needed: pairs over equal prefix shingles whose bounds allow a link; sides have x, n, i and y, m, j, the left one
    the number of shingles that a row stands for."""
    n, m, i, j = (F.col(c) for c in "nmij")
    needed = least_common(n, m, percent)
    fits = (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (F.least(i, j) + F.least(n - i, m - j) >= needed)
    rows = left.join(right.withColumnRenamed("h", "h_y"), (F.col("h") == F.col("h_y")) & (F.col("label") != F.col("label_y")) & fits)
    bound = F.greatest(least_overlap(n, percent), least_overlap(m, percent)) - 1
    rows = rows.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), needed.alias("needed"), bound.alias("bound"), "weight")
    return rows.groupBy("a", "b", "needed", "bound").agg(F.sum("weight").alias("seen")).filter("seen + bound >= needed").select("a", "b", "needed")


def first_common(rows: DataFrame, percent: int) -> DataFrame:
    """a, b, needed, bound: every pair of different labels that can link; rows have h, x, n, i, label.

    The first shingle, in the global order, that two sets share leaves them ``1 + min(n - i, m - j)`` in common at most.
    A pair is built at a shingle that can be its first one. The smaller set offers those that can be first with
    a set of its own size; the larger one those that can be first with the smallest set that offers the shingle. So a
    passage that many sets share is no key for a set with as many rarer shingles of its own as a link may leave out."""
    n, m, i, j = (F.col(c) for c in "nmij")
    small = rows.filter(1 + n - i >= least_common(n, n, percent))
    offers = small.groupBy("h").agg(F.min("n").alias("least"), F.min("label").alias("low"), F.max("label").alias("high"))
    large = rows.join(offers, "h").filter((F.col("low") != F.col("label")) | (F.col("high") != F.col("label")))
    large = large.filter(1 + n - i >= least_common(n, F.greatest("least", least_overlap(n, percent)), percent)).select(*rows.columns)
    small = small.select(F.col("h").alias("h_y"), F.col("x").alias("y"), n.alias("m"), i.alias("j"), F.col("label").alias("label_y"))
    needed = least_common(n, m, percent)
    fits = ((n > m) | (n == m) & (F.col("x") > F.col("y"))) & (m * 100 >= n * percent) & (1 + F.least(n - i, m - j) >= needed)
    pairs = large.join(small, (F.col("h") == F.col("h_y")) & (F.col("label") != F.col("label_y")) & fits)
    bound = F.greatest(least_overlap(n, percent), least_overlap(m, percent)) - 1
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), needed.alias("needed"), bound.alias("bound")).distinct()


def enough_seen(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """a, b, needed: the pairs whose whole prefixes have enough in common; rows have h, x, weight."""
    held = F.map_from_entries(F.collect_list(F.struct("h", "weight")))  # a part of the prefix of one text
    prefix = rows.groupBy("x").agg(held.alias("held"))
    left, right = prefix.select(F.col("x").alias("a"), F.col("held").alias("of_a")), prefix.select(F.col("x").alias("b"), F.map_keys("held").alias("of_b"))
    seen = F.aggregate(F.array_intersect(F.map_keys("of_a"), "of_b"), F.lit(0).cast("long"), lambda sum_, h: sum_ + F.col("of_a")[h])
    return pairs.join(left, "a").join(right, "b").filter(seen + F.col("bound") >= F.col("needed")).select("a", "b", "needed")


def join_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    session, texts = docs.sparkSession, docs.select("doc_id", "text")
    shared, n_rows = Tables(session), texts.count()
    digests = shared(set_digests(texts, size).repartition(1 + n_rows // FILE_ROWS))
    heavy = session.sparkContext.broadcast(frequent(digests))

    classes = digests.filter("n >= 0")
    reps = shared(classes.filter("n > 0").groupBy("n", "first", "second").agg(F.min("doc_id").alias("rep")), n_rows)
    members = classes.join(reps, ["n", "first", "second"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep"))

    named = texts.filter("doc_id is not null")
    if not classes.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        named = shared(named.groupBy("doc_id").agg(F.min("text").alias("text")))  # the one shuffle of texts, where ids repeat
    named = named.select("doc_id", "text", F.xxhash64("doc_id").alias("mark"))

    def those(ids: DataFrame):
        """A filter of fixed size for the documents that are wanted; what else it lets pass changes no result."""
        return session.sparkContext.broadcast(bit_filter(ids.select(F.xxhash64(ids.columns[0]).alias("mark"))))

    whole = shared(prefixes(named, size, percent, heavy, those(reps.select("rep").filter("rep is not null"))))
    repeated = shared(whole.groupBy("h").count().filter("count > 1"), whole.count())
    n_likely, mixed = repeated.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0], F.xxhash64("rep")
    likely = shared(of_hashes(whole, session.sparkContext.broadcast(bit_filter(repeated.select("h")))), n_likely)
    texts_kept = [t for t in shared.open.values() if t is not None and t.columns == ["doc_id", "text"]]
    shared.drop(digests, reps, likely, *texts_kept)
    held = (F.count("*").alias("df"), F.bit_xor(mixed).alias("mixed"), F.sum(F.shiftright(mixed, 32)).alias("total"), F.min("position").alias("at"))
    common = likely.groupBy("h").agg(*held).filter("df > 1")
    first = F.min(F.struct("at", "h"))["h"].alias("h")  # one posting list: the least position is that of the first in the global order
    kept = shared(common.groupBy("df", "mixed", "total").agg(first, F.count("*").alias("weight")).select("h", "df", "weight"), n_likely)
    prefix = shared(likely.join(kept, "h"), n_likely)
    n_prefix = prefix.count()
    weight = F.sum("weight")
    rank = prefix.groupBy("rep").agg((-weight / (F.max("n") - least_overlap(F.max("n"), percent) + 1)).alias("lone"), (-F.sum(F.col("df") * F.col("weight")) / weight).alias("rare"))
    prefix = shared(prefix.join(rank, "rep").drop("df"), n_prefix)
    shared.drop(digests, reps, prefix, *texts_kept)
    links, labels, live = None, prefix.select(F.col("rep").alias("node"), F.col("rep").alias("label")).distinct(), [digests, reps, prefix, *texts_kept]
    for round_ in range(PIVOT_ROUNDS + 1):
        now = prefix.join(labels, prefix.rep == labels.node).drop("node")
        left = now.select("h", F.col("rep").alias("x"), "n", F.col("position").alias("i"), "label", "weight")
        if round_ < PIVOT_ROUNDS:
            free = now if round_ == 0 else now.filter("rep <> label")
            pivot = F.min(F.struct("lone", "rare", "rep", F.col("n").alias("m"), F.col("position").alias("j"), "label")).alias("p")
            other = free.groupBy("h").agg(pivot).select("h", F.col("p.rep").alias("y"), "p.m", "p.j", F.col("p.label").alias("label_y"))
            pairs = shared(candidates(left, other, percent), n_prefix)  # one at most for each row
        else:
            split = now.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("h")
            left = shared(left.join(split, "h", "left_semi"), n_prefix)
            first = shared(first_common(left, percent))
            pairs = shared(enough_seen(first, left), first.count())
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        # The parts are cut once for each side: as a table they would be a file of every task that reads texts.
        found = shared(overlaps(pairs, fragments(named, size, heavy, those(ids))), pairs.count())
        links = found if links is None else links.union(found)
        joined = components(links, shared)
        live.append(found)
        shared.drop(*live, joined)
        labels = prefix.select("rep").distinct().join(joined, F.col("rep") == F.col("node"), "left").select(F.col("rep").alias("node"), F.coalesce("label", "rep").alias("label"))
    shared.drop(digests, reps, joined)
    result = members.join(joined, members.rep == joined.node, "left")
    return dealt_by_rows(result.select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id")), n_rows)
