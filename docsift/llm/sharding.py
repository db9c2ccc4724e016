"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in column functions only.

Every shard has ``points`` places on a ring, every document one, by a hash of its id. A document goes to the
next place clockwise; a shard takes documents up to its capacity, in an order fixed by a second hash of the
id, and those beyond continue clockwise to the next shard that has room. Capacities add up to the number of
rows, so that counts are at most one apart (the first ``rows mod shards`` shards hold one more).

A round gives every unplaced document the owner of its arc on the ring of the shards that still have room,
numbers the askers of each shard over ranges (no shard is one task), and places the first of them; that
number is the slot as well. Each round fills a shard or places everything, and what remains shrinks fast:
with 128 places, a few hundredths of the rows after the first round. Only the ring (``shards * points``
arcs, cut at cells so that the join is by equality) is broadcast and one count per shard is collected.

Growth by one shard moves the rows that the new shard takes and those that the smaller capacities push on.

Null ids share one place and are told apart by size, checksum and place in the table. Repeated rows are rows
of their own. A null text has no bytes. An empty table gives an empty result, as do more shards than rows
give empty shards. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.operators.order import RANGE_ROWS, group_index
from docsift.operators.stored import stored

LAW = "rows"
POINTS = 128
_BITS = 12  # the ring of 2**63 places has 2**12 cells
_END = 2**63 - 1


def _place(*columns):
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def ring(spark: SparkSession, shards: int, points: int = POINTS) -> DataFrame:
    """shard, point of every virtual node."""
    node = spark.range(shards * points).select(F.floor(F.col("id") / points).cast("int").alias("shard"), (F.col("id") % points).alias("copy"))
    return node.select("shard", _place(F.lit("node"), "shard", "copy").alias("point"))


def arcs(nodes: DataFrame) -> DataFrame:
    """cell, low, high, shard: the places above ``low`` up to ``high`` belong to the shard, once per cell they touch."""
    around = Window.orderBy("point", "shard")  # of the ring, whose size doesn't follow the data
    own = nodes.select("shard", F.lag("point", 1, -1).over(around).alias("low"), F.col("point").alias("high"))
    first = nodes.agg(F.min_by("shard", F.struct("point", "shard")).alias("shard"), F.max("point").alias("low")).withColumn("high", F.lit(_END))
    both = own.unionByName(first)
    cells = F.sequence(F.shiftright(F.col("low") + 1, 63 - _BITS), F.shiftright("high", 63 - _BITS))
    return both.where("low < high").select(F.explode(cells).alias("cell"), "low", "high", "shard")


def place(rows: DataFrame, shards: int, points: int = POINTS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Adds shard and slot to rows with point, turn and further columns that make the order of the rows."""
    spark = rows.sparkSession
    total = rows.count()
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    order = ["turn", *[c for c in rows.columns if c != "turn"]]
    nodes, done, left = ring(spark, shards, points), [], total
    while left:
        open_ = [s for s in range(shards) if room[s] > used[s]]
        owner = F.broadcast(arcs(nodes.where(F.col("shard").isin(open_))))
        at = F.shiftright("point", 63 - _BITS) == F.col("cell")
        asked = rows.join(owner, at & (F.col("point") > F.col("low")) & (F.col("point") <= F.col("high"))).drop("cell", "low", "high")
        numbered = group_index(asked, ["shard"], order, "slot", range_rows=range_rows)
        free = F.get(F.lit([r - u for r, u in zip(room, used)]), F.col("shard"))
        taken = F.get(F.lit(list(used)), F.col("shard"))
        fits = F.col("slot") < free
        done.append(numbered.where(fits).withColumn("slot", F.col("slot") + taken))
        for shard, count in numbered.groupBy("shard").agg(F.count_if(fits)).collect():  # one row per shard
            used[shard] += count
            left -= count
        rows = numbered.where(~fits).select(*rows.columns)
    if not done:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    return reduce(DataFrame.unionByName, done)


def shard_documents(docs: DataFrame, shards: int, points: int = POINTS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            _place(F.lit("key"), "doc_id").alias("point"), F.xxhash64(F.lit("turn"), "doc_id").alias("turn"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    placed = place(rows, shards, points, range_rows)
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
