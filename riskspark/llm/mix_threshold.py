"""Mixing sources to target weights by hash thresholds.

The size of a document is its number of words. Sources, in code point order and null last, have the weights
``WEIGHTS`` in turn; together they are to fill ``SHARE`` of all sizes, each at most ``MOST`` times its own size, what is
beyond that shared out again by weight: the level of a fill, found from running totals over the sources by ratio of
limit to weight.

A source's target is a whole number of copies of all its documents and a budget smaller than its size. Which
documents the budget takes is a threshold of a hash of the document: sizes are summed by source and leading bits of
the hash (a histogram, pre-aggregated), the running sums over the buckets give the one in which the budget ends, and only
the documents of that bucket are looked at again, by the next bits, until it is a single hash value; that is
taken if at least half of its size fits. Copies and budgets are nested: a larger budget takes the same documents and
more. Nothing is sorted but the buckets of a source, and the result is a filter on the hash.

The hash is over doc_id and text, so that rows without doc_id spread; rows equal in both move together, which
is the least that can be told apart. Null and empty texts have size 0. A source without words has target 0. Repeated
rows are documents of their own; further columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import WORD, Stash, only
from riskspark.operators.cumulative import running_totals
from riskspark.session import temporary_tables

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SEED = "mix"
#: Bits of the hash (leading hexadecimal digits of a digest) and of a step of the histogram.
BITS, STEP = 48, 12


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size, h)``."""
    rows = only(docs, doc_id="bigint", text="string", source="string")
    digest = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"),
                            F.md5(F.coalesce("text", F.lit("")))))
    return rows.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
                       F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint").alias("h"))


def targets(sizes: DataFrame, stash: Stash, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sizes(source, source_size)``, one row for each source, with ``weight`` and ``target``."""
    with temporary_tables(sizes.sparkSession):
        ranked = stash.put(running_totals(sizes.withColumn("one", F.lit(1).cast("bigint")), "source", ["one"]).select(
            "source", "source_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (1 + (F.col("cum_one") - 1) % len(weights)).cast("int")).alias("weight")))
        limit = F.lit(float(most)) * F.col("source_size")
        level = ranked.groupBy((limit / F.col("weight")).alias("ratio")).agg(
            F.sum("source_size").alias("full"), F.sum("weight").alias("weights"))
        run = running_totals(level, "ratio", ["full", "weights"])
        goal = F.lit(share) * F.col("tot_full")
        full = F.lit(float(most)) * F.col("cum_full")
        open_ = F.col("tot_weights") - F.col("cum_weights")
        # sources up to the last ratio at which the fill does not exceed the goal are full
        top = run.where(full + F.col("ratio") * open_ <= goal).agg(F.max_by(F.struct("ratio", full.alias("full"), open_.alias("open")), "ratio").alias("m")).first()["m"]
        total = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    ratio, filled, left = (top["ratio"], top["full"], top["open"]) if top else (-1.0, 0.0, total[1] or 0.0)
    water = (share * (total[0] or 0) - filled) / left if left else 0.0
    return ranked.withColumn("target", F.when(limit / F.col("weight") <= F.lit(ratio), limit).otherwise(F.lit(water) * F.col("weight")))


def thresholds(rows: DataFrame, plan: DataFrame, stash: Stash) -> DataFrame:
    """``plan(source, source_size, target)`` with ``copies`` of all documents and ``cut``: documents whose hash is at most
    that are taken once more (-1: none)."""
    size = F.col("source_size")
    copies = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int")
    state = stash.put(plan.select("*", copies.alias("copies"), (F.col("target") - copies * size).alias("budget"),
                                  F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("before")))
    part = rows  # documents of the buckets in which the budgets end
    for shift in range(BITS - STEP, -1, -STEP):
        at = state.select(F.col("source").alias("s"), "prefix", "before", "budget")
        same = F.col("source").eqNullSafe(F.col("s"))
        if shift < BITS - STEP:
            inside = stash.put(part.join(at, same & (F.shiftright("h", shift + STEP) == F.col("prefix")), "left_semi"))
            if part is not rows:
                stash.drop(part)
            part = inside
        buckets = part.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("n"))
        # at most 2 ** STEP buckets of a source
        run = F.sum("n").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
        summed = buckets.select("source", "b", "n", F.coalesce(run, F.lit(0)).alias("upto")).join(at, same)
        first = F.col("before") + F.col("upto")
        ends = first + F.col("n") > F.col("budget") if shift else 2 * first + F.col("n") > 2 * F.col("budget")
        found = summed.where(ends).groupBy("source").agg(F.min_by(F.struct(F.col("b"), first.alias("before")), "b").alias("m"))
        old = state
        # a budget may take all hashes of the last bucket; without words it ends nowhere (null)
        prefix = F.col("m.b") if shift else F.coalesce("m.b", F.shiftleft(F.col("prefix") + 1, STEP))
        state = stash.put(state.join(found.select(F.col("source").alias("s"), "m"), F.col("source").eqNullSafe(F.col("s")), "left")
                          .select(*[c for c in state.columns if c not in ("prefix", "before")], prefix.alias("prefix"),
                                  F.col("m.before").alias("before")))
        stash.drop(old)
    # the last prefix is the first hash not taken
    return state.select("source", "source_size", "target", "copies", (F.coalesce("prefix", F.lit(0)) - 1).alias("cut"))


def mix(docs: DataFrame) -> DataFrame:
    """Words that the mix takes of every document (columns of the query)."""
    stash = Stash(docs.sparkSession, "mix")
    rows = stash.put(sized(docs))
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), stash)
    cuts = thresholds(rows, plan, stash).withColumnRenamed("source", "s")
    return rows.join(cuts, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("copies") + (F.col("h") <= F.col("cut")).cast("int"))).alias("taken"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    ('0x' || substr(md5(concat('{SEED}', ':', coalesce(doc_id::VARCHAR, '-'), ':', md5(coalesce(text, '')))), 1, 12))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ([3.0, 1.0, 2.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio FROM s),
f AS (SELECT ratio, 2.0::DOUBLE * sum(source_size) OVER (ORDER BY ratio) AS fulled, sum(weight) OVER () - sum(weight) OVER (ORDER BY ratio) AS left_over,
    1.5::DOUBLE * sum(source_size) OVER () AS goal FROM r),
top AS (SELECT coalesce(max(ratio) FILTER (WHERE fulled + ratio * left_over <= goal), -1) AS ratio FROM f),
w AS (SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM r) - coalesce(2.0::DOUBLE * sum(source_size) FILTER (WHERE r.ratio <= top.ratio), 0))
    / nullif(sum(weight) FILTER (WHERE r.ratio > top.ratio), 0) AS water FROM r, top),
t AS (SELECT source, source_size, CASE WHEN r.ratio <= top.ratio THEN 2.0::DOUBLE * source_size ELSE water * weight END AS target FROM r, top, w),
c AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM t),
g AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
u AS (SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h) - n AS before FROM g)
SELECT d.doc_id, d.size, c.source_size, c.target,
    (d.size * (c.copies + CASE WHEN 2 * u.before + u.n <= 2 * (c.target - c.copies * c.source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source JOIN u ON d.source IS NOT DISTINCT FROM u.source AND d.h = u.h
"""
