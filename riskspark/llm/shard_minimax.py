"""Sharding by minimax contiguous partition.

Documents with equal text form one atomic group. Groups stand in the order of their text's digest;
their running sizes are a table in the shared folder. The smallest capacity for which a greedy pass
needs no more than the wanted number of shards is found by bisection: a pass fills each shard with as
many groups as fit, and each of its steps is one lookup ("the last group ending within start +
capacity"), a pruned read of the sorted table with a maximum that is pre-aggregated. Six halvings are
taken at once: a job looks up 63 capacities side by side. So the driver holds 63 positions and
16 cuts, never the groups.

Then the order is cut: within the smallest capacity each shard ends at the group nearest above its
even share of what is left, or below it if that would pass the capacity; if the last shard would then
pass the capacity, the greedy cuts themselves are taken.

A document's shard follows from its digest and the cuts, without a join. Slots are numbered within
pieces of a shard (by a hash of doc_id) plus the rows of the pieces before, so that no window holds a
whole shard. Null text counts as no bytes (size 1) and is grouped with the empty text; its checksum is
that of no bytes. Repeated rows are documents of their own and get their own slots. An empty table
gives an empty result; fewer groups than shards leave the last shards empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import Stash, only

SHARDS = 16
#: Capacities looked up at once (six halvings), and rows in a piece of a shard.
AT_ONCE, PIECE = 63, 10_000
#: Leading digits of the digest that divide the order for running sums (16 ** 3 parts).
DIGITS = 3


def running_sizes(groups: DataFrame) -> DataFrame:
    """``groups(g, bytes)`` with ``upto``, the size of all groups up to this one in the order of g."""
    part = F.substring("g", 1, DIGITS)
    totals = groups.groupBy(part.alias("part")).agg(F.sum("bytes").alias("n"))
    # at most 16 ** DIGITS rows
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("bytes").over(Window.partitionBy("part").orderBy("g"))
    return (groups.withColumn("part", part).join(F.broadcast(before), "part")
            .select("g", "bytes", (F.col("before") + inside).alias("upto")))


class Order:
    """Lookups in the table of running sizes."""

    def __init__(self, table: DataFrame, total: int, largest: int) -> None:
        self.table, self.total, self.largest = table, total, largest

    def last_within(self, limits: list[int]) -> list[int]:
        """For each of the rising limits, the end of the last group that ends within it (0: none)."""
        near = self.table.where((F.col("upto") > limits[0] - self.largest) & (F.col("upto") <= limits[-1]))
        place = F.size(F.filter(F.array(*[F.lit(x).cast("bigint") for x in limits]), lambda x: x < F.col("upto")))
        got = {r["k"]: r["m"] for r in near.groupBy(place.alias("k")).agg(F.max("upto").alias("m")).collect()}
        out, best = [], 0
        for k, limit in enumerate(limits):
            best = max(best, got.get(k, 0))
            out.append(best)
        return out

    def around(self, want: int) -> tuple[int, int]:
        """Ends of the last group within ``want`` and of the first at or beyond it (0 and the total at the ends)."""
        upto = F.col("upto")
        near = self.table.where((upto > want - self.largest) & (upto <= want + self.largest))
        below, above = near.agg(F.max(F.when(upto <= want, upto)), F.min(F.when(upto >= want, upto))).first()
        return below or 0, self.total if above is None else above

    def greedy(self, capacities: list[int], shards: int) -> list[list[int]]:
        """For each of the rising capacities, where its shards end."""
        ends: list[list[int]] = [[] for _ in capacities]
        for _ in range(shards):
            at = [e[-1] if e else 0 for e in ends]
            if min(at) >= self.total:
                break
            for e, x in zip(ends, self.last_within([a + c for a, c in zip(at, capacities)])):
                e.append(x)
        return ends


def cuts(order: Order, shards: int) -> list[int]:
    """Ends of the shards but the last, for the smallest feasible capacity."""
    share = -(-order.total // shards)
    low, high = max(share, order.largest), share + order.largest  # a pass with the latter always fits
    best: list[int] | None = None
    while low < high or best is None:
        step = max(1, -(-(high - low) // (AT_ONCE + 1)))
        tried = sorted({min(high, low + i * step) for i in range(AT_ONCE)} if low < high else {low})
        for capacity, ends in zip(tried, order.greedy(tried, shards)):
            if ends[-1] >= order.total:
                high, best = capacity, ends
                break
            low = capacity + 1
    even, at = [], 0
    for left in range(shards, 1, -1):
        want = at + -(-(order.total - at) // left)
        below, above = order.around(want)
        end = above if above - at <= high else max(at, below)
        even.append(end)
        at = end
    return even if order.total - at <= high else best[:shards - 1]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document (columns of the query)."""
    spark = docs.sparkSession
    stash = Stash(spark, "shards")
    text = F.coalesce("text", F.lit(""))
    rows = stash.put(only(docs, doc_id="bigint", text="string").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("g")))
    groups = rows.groupBy("g").agg(F.sum("size").alias("bytes"))
    table = stash.put(running_sizes(groups).repartitionByRange("upto").sortWithinPartitions("upto"))
    total, largest = table.agg(F.max("upto"), F.max("bytes")).first()
    order = Order(table, total or 0, largest or 0)
    ends = [e for e in cuts(order, shards) if 0 < e < order.total] if total else []
    named = {r["upto"]: r["g"] for r in table.where(F.col("upto").isin(ends)).collect()} if ends else {}
    number = F.size(F.filter(F.array(*[F.lit(named[e]) for e in ends]), lambda g: g < F.col("g"))) if ends else F.lit(0)
    placed = rows.withColumn("shard", number.cast("int"))
    sizes = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    pieces = F.array(*[F.lit(max(1, -(-sizes.get(s, 0) // PIECE))) for s in range(shards)])
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.get(pieces, F.col("shard"))))
    counts = placed.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    w = Window.partitionBy("shard").orderBy("piece")
    before = counts.select("shard", "piece", (F.sum("n").over(w) - F.col("n")).alias("before"))
    at = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("doc_id", "g"))
    return placed.withColumn("at", at).join(before, ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("at") - 1).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

