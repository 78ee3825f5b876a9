"""Helpers shared by the corpus operators: input projection, tables in the shared folder, and
connected components over an edge table."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import at_end_delete, checkpoint_dir, delete_table

#: Words of the near-duplicate, quality and decontamination operators (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import the package from here, as the driver
    does; on a cluster it is installed or given with ``--py-files``, and the path is without effect."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def only(df: DataFrame, **types: str) -> DataFrame:
    """The named columns alone, cast to their types: further columns of the input, whatever their
    names, cannot clash with an operator's own."""
    importable(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])


class Stash:
    """Parquet tables in the shared checkpoint folder, which cut lineage and outlive executors.

    ``put`` writes a plan once and reads it back; ``drop`` deletes tables no later plan reads; those that
    results still read are deleted when the application ends."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def put(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = at_end_delete(f"{self.root}/{self._n}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stash_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_stash_path", None)
        if path is not None:
            delete_table(self.spark, path)


def components(edges: DataFrame, stash: Stash) -> DataFrame:
    """``(id, component)`` for every id of ``edges(a, b)``; component is the smallest id reachable.

    Alternating large-star and small-star rounds: every round links nodes to the smallest
    neighbour seen, so the rounds grow with the logarithm of the longest path. Minima are
    pre-aggregated before the shuffle; the joins are plain equi-joins that adaptive execution
    may split at a hot centre. Edges never reach the driver, only a count and a checksum do."""

    def mark(df: DataFrame):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = stash.put(edges.where("a is not null and b is not null and a != b")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s"))
        nxt = stash.put(small.select("s.a", "s.b").where("a != b").distinct())
        now = mark(nxt)
        stash.drop(e)
        e = nxt
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
