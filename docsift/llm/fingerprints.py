"""Document fingerprints from closed syncmers, by column functions alone.

Units are runs without white space (A-Z etc. lowered) and single ideographs. A run of ``K`` units
is a closed syncmer if its least inner run of ``S`` units is its first or last one: a choice that
depends on the run alone, so an edit moves no anchor outside it. ``anchors`` gives every syncmer of
the whole text with its place, however long the text; of equal runs the first place counts.

Two fingerprints are matched by position. Anchors with one hash pair up, and each pair has an offset.
A pair counts fully when its offset is the median one and less the further it is off, down to nothing at
3 / 16 of the larger number of anchors (about an eighth of the longer text); the sum is divided by the number of
different anchors of both. So the
likeness of equal texts is 1, an edit lowers it by its share of the anchors, an insertion shifts all
that follows by its length, and the same blocks in another order count little.

Null text is empty; empty text has the empty fingerprint; text with fewer than ``K`` units, or with
none, is one anchor. Equal texts have equal fingerprints. Two empty fingerprints are alike (1). Hashes
have 32 bits: of two texts with 13,000 anchors about 40 pair up by chance, which the offsets mostly undo.

A repeated row is a row of its own; of rows that share an id and differ, the least text is the neighbour's
next. Rows without an id have no next text: their end is cut off, and nothing is near. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import shared
from docsift.operators.order import global_index

K, S = 4, 2
UNITS = r"\\p{IsIdeographic}|[^\\s\\p{IsIdeographic}]+"
BLOCKS = 100_000  # of ids that stand together; also the bound on seams that are broadcast, doubled
LEAST_BLOCK = 16


def anchors(text: str) -> Column:
    """array<long> of the SQL expression ``text``: hash (32 bits), place (31 bits), a zero; in that order, a hash once.

    Let-bindings keep each array computed once. No array may hold a null by its type, so that whole numbers are
    sorted as such."""
    # S = 2 and K = 4: three inner runs, of which an outer one has to be the least
    closed = f"filter(sequence(1, size(w) - {K - 1}), i -> least(m[i - 1], m[i + 1]) <= m[i])"
    packed = f"transform({closed}, i -> shiftleft(cast(hash(w[i - 1], w[i], w[i + 1], w[i + 2]) as bigint), 32) + 2 * i)"
    inner = f"transform(array(transform(w, (u, i) -> hash(u, get(w, i + 1)))), m -> {packed})[0]"
    one = "array(shiftleft(cast({} as bigint), 32) + 2)"
    body = f"case when size(w) >= {K} then {inner} when size(w) > 0 then {one.format('hash(w)')} when t = '' then slice(array(0L), 1, 0) else {one.format('hash(t)')} end"
    found = f"transform(array(transform(regexp_extract_all(t, '{UNITS}', 0), u -> hash(u))), w -> {body})[0]"
    first = f"transform(array(sort_array({found})), a -> filter(a, (x, i) -> i = 0 or shiftright(x, 32) <> shiftright(a[i - 1], 32)))[0]"
    return F.expr(f"transform(array(lower(coalesce({text}, ''))), t -> {first})[0]")


def printed(found: str) -> Column:
    """The anchors' hashes, in the order of the hashes."""
    return F.expr(f"array_join(transform({found}, x -> lpad(hex(shiftright(x, 32) & 4294967295), 8, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Share of the anchors of both that pair up at a consistent offset."""
    both = f"sort_array(concat({a}, transform({b}, x -> x + 1)))"
    pairs = "filter(sequence(0, size(m) - 2), i -> shiftright(m[i], 32) = shiftright(m[i + 1], 32))"
    place = "shiftright(m[{0}] & 4294967295, 1)"
    side = "(2 * (m[i + 1] & 1) - 1)"  # whether the later entry is the second text's
    offsets = f"sort_array(transform({pairs}, i -> {side} * ({place.format('i + 1')} - {place.format('i')})))"
    # bound, so that it is not computed for every offset
    reach = f"greatest(8D, greatest(size({a}), size({b})) * 3 / 16D)"
    weight = f"transform(array({reach}), r -> aggregate(d, 0D, (acc, x) -> acc + greatest(0D, 1 - abs(x - d[size(d) div 2]) / r)))[0]"
    score = f"transform(array({offsets}), d -> case when size(d) = 0 then 0D else {weight} / (size(m) - size(d)) end)[0]"
    some = f"transform(array({both}), m -> case when size(m) < 2 then 0D else {score} end)[0]"
    return F.expr(f"case when {a} = {b} then 1D else {some} end")


def in_blocks(docs: DataFrame) -> DataFrame:
    """block, turn, doc_id, text, real: the rows with an id by blocks of ids, and in each block the row before its first.

    Texts move once, by block. ``turn`` is the id; the copy of the largest id stands before the smallest. The copies come
    from one row per block, found on ids alone."""
    rows = docs.filter("doc_id is not null").select("doc_id", "text")
    width = max(LEAST_BLOCK, docs.count() // BLOCKS)
    block = F.expr(f"(doc_id - pmod(doc_id, {width})) div {width}")
    tops = rows.select("doc_id").groupBy(block.alias("block")).agg(F.max("doc_id").alias("top"))
    placed = shared(global_index(tops, ["block"], "place", total="n"))
    follows = F.pmod(F.col("place") + 1, F.col("n"))
    seams = placed.select("top", follows.alias("next_place")).join(placed.select(F.col("place").alias("next_place"), F.col("block").alias("to_block")), "next_place")
    seams = shared(seams.select(F.col("top").alias("doc_id"), "to_block", F.when(F.col("next_place") == 0, F.col("to_block") * width - 1).otherwise(F.col("top")).alias("turn")))
    few = seams.count() <= 2 * BLOCKS
    copies = rows.join(F.broadcast(seams) if few else seams, "doc_id").select(F.col("to_block").alias("block"), "turn", "doc_id", "text", F.lit(False).alias("real"))
    own = rows.select(block.alias("block"), F.col("doc_id").alias("turn"), "doc_id", "text", F.lit(True).alias("real"))
    return own.unionByName(copies).repartition("block")


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the text with its end replaced by the next one's start, and their likeness."""
    rows = in_blocks(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).withColumn("own", anchors("text"))
    same = Window.partitionBy("block", "turn")
    rows = rows.withColumn("least", F.min("text").over(same)).withColumn("least_own", F.min_by("own", "text").over(same))
    before = Window.partitionBy("block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("next", F.last("least").over(before)).withColumn("next_own", F.last("least_own").over(before)).filter("real")
    rows = rows.select("doc_id", "text", "own", "next", "next_own")
    alone = docs.filter("doc_id is null").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("own", anchors("text"))
    none = F.lit(None).cast("array<bigint>")
    rows = rows.unionByName(alone.withColumn("next", F.lit("")).withColumn("next_own", none))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    cut = "cast(floor(n_chars / 3) as int)"
    rows = rows.withColumn("edited", F.expr(f"concat(substring(text, 1, cast(n_chars as int) - {cut}), substring(next, 1, {cut}))"))
    # a generated row, so that each array is computed once
    bound = F.explode(F.array(F.struct("own", anchors("edited").alias("other"), "next_own"))).alias("s")
    rows = rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), bound)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", printed("s.own").alias("fingerprint"), printed("s.other").alias("edited_fingerprint"),
        likeness("s.own", "s.other").alias("near_edited"), F.when(F.col("s.next_own").isNull(), 0.0).otherwise(likeness("s.own", "s.next_own")).alias("near_next"),
    )
