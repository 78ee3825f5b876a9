"""Isotonic regression by pooling adjacent violators in blocks (CAL1), and lookups in its result.

Points are the distinct x with their summed weights and weighted labels. The fit is the slope of
the lower convex hull of the running sums (weight, weighted label), and pooling is associative: a stretch of
points may be pooled on its own before it meets its neighbours.

1. The points are range-partitioned into blocks. A task runs through its block in order and keeps a stack of
   pooled stretches, nothing else.
2. What the blocks leave over is one table with running sums. A stretch of it longer than a block is cut
   at the point farthest below the chord of its running sums: that point lies on the hull, so nothing is pooled
   across it and both sides are independent. If no point lies below the chord, the stretch is one pooled value.
   A round is one pre-aggregated scan for all long stretches; the driver holds only their cuts.
3. Each stretch that fits a block is pooled by one task.

The boundaries (both ends of every pooled stretch with its value) are a table. A lookup is a binary search in a literal
array of at most ``FEW`` numbers: the boundaries themselves if they are as few, else the first boundary of each cell of
boundaries, and the cell is joined and searched. Both are projections and equi-joins, so streams can use them.

The stack is the one step that built-in functions cannot express: it runs in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.exprs import double_array, search
from riskspark.operators.cumulative import BLOCK_ROWS, running_totals
from riskspark.session import materialize

#: Numbers of a literal array at most, and boundaries of a cell at least.
FEW, CELL = 20_000, 1_000
_STRETCH = "lo double, hi double, s double, w double"


class Stack:
    """Pooled stretches (first x, last x, weighted label, weight) of rising means."""

    def __init__(self) -> None:
        self.lo: list[float] = []
        self.hi: list[float] = []
        self.s: list[float] = []
        self.w: list[float] = []

    def push(self, lo: float, hi: float, s: float, w: float) -> None:
        while self.s and self.s[-1] * w >= s * self.w[-1]:
            lo = self.lo.pop()
            self.hi.pop()
            s += self.s.pop()
            w += self.w.pop()
        self.lo.append(lo)
        self.hi.append(hi)
        self.s.append(s)
        self.w.append(w)

    def push_all(self, rows: pd.DataFrame) -> None:
        for row in zip(rows["lo"].tolist(), rows["hi"].tolist(), rows["s"].tolist(), rows["w"].tolist()):
            self.push(*row)

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"lo": self.lo, "hi": self.hi, "s": self.s, "w": self.w}, dtype="float64")


def _pool_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    stack = Stack()
    for rows in batches:
        stack.push_all(rows)
    yield stack.frame()


def _pool_group(rows: pd.DataFrame) -> pd.DataFrame:
    stack = Stack()
    stack.push_all(rows.sort_values("lo"))
    return stack.frame()


def points(df: DataFrame, x: str, y: str, weight: str | None = None) -> DataFrame:
    """Distinct x (NULL and NaN left out) with summed weights and weighted labels; weights of 0 or less do not count."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(xs.alias("x"), (ys * w).alias("s"), w.alias("w")).where("x is not null and s is not null and w > 0 and not isnan(x)")
    return rows.groupBy((F.col("x") + F.lit(0.0)).alias("lo")).agg(F.sum("s").alias("s"), F.sum("w").alias("w")).select(
        "lo", F.col("lo").alias("hi"), "s", "w")


@dataclass
class _Part:
    """Points after ``first`` up to ``last``, running (weight, label, rows) sums; ``flat``: one pooled value."""

    first: tuple[float, float, int]
    last: tuple[float, float, int]
    flat: bool = False

    @property
    def rows(self) -> int:
        return self.last[2] - self.first[2]


def _cut(run: DataFrame, parts: list[_Part], block_rows: int) -> list[_Part]:
    """One round: every part longer than a block that is not flat is cut at its lowest point, or found flat."""
    number, n = F.col("part"), len(parts)
    tagged = run.select("cum_w", "cum_s", "cum_one", _part_of(parts).alias("part")).where(
        number.isin([i for i, p in enumerate(parts) if p.rows > block_rows and not p.flat]))

    def of(values: list[float]) -> Column:
        return F.get(double_array(values), number)

    slope = [(p.last[1] - p.first[1]) / (p.last[0] - p.first[0]) for p in parts]
    gap = F.col("cum_s") - of([p.first[1] for p in parts]) - of(slope) * (F.col("cum_w") - of([p.first[0] for p in parts]))
    lowest = F.min_by(F.struct("cum_w", "cum_s", "cum_one", "gap"), F.struct("gap", "cum_w")).alias("m")
    low = {r["part"]: r["m"] for r in tagged.select("*", gap.alias("gap")).groupBy("part").agg(lowest).collect()}
    out = []
    for i, p in enumerate(parts[:n]):
        m = low.get(i)
        if m is None:
            out.append(p)
        elif m["cum_one"] == p.last[2] or m["gap"] >= -1e-12 * max(1.0, abs(p.last[1] - p.first[1])):
            out.append(_Part(p.first, p.last, True))
        else:
            at = (m["cum_w"], m["cum_s"], m["cum_one"])
            out += [_Part(p.first, at), _Part(at, p.last)]
    return out


def _part_of(parts: list[_Part]) -> Column:
    return search(double_array([p.last[0] for p in parts[:-1]]), len(parts) - 1, F.col("cum_w"), below=True)


def _merged(stretches: DataFrame, block_rows: int) -> DataFrame:
    """Pooled stretches of a table of stretches, however long."""
    run = materialize(running_totals(stretches.withColumn("one", F.lit(1).cast("bigint")), "lo", ["s", "w", "one"], block_rows=block_rows).select(
        "lo", "hi", "s", "w", "cum_s", "cum_w", "cum_one"), "isotonic-sums")
    end = run.agg(F.max_by(F.struct("cum_w", "cum_s", "cum_one"), "cum_one").alias("e")).first()["e"]
    parts = [_Part((0.0, 0.0, 0), tuple(end))]
    while any(p.rows > block_rows and not p.flat for p in parts):
        parts = _cut(run, parts, block_rows)
    rows = run.select("lo", "hi", "s", "w", _part_of(parts).alias("part"))
    flat = F.col("part").isin([i for i, p in enumerate(parts) if p.flat])
    whole = rows.where(flat).groupBy("part").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"), F.sum("w").alias("w")).drop("part")
    return whole.unionByName(rows.where(~flat).groupBy("part").applyInPandas(_pool_group, _STRETCH))


# ---- lookups -------------------------------------------------------------------------------------

def _interpolated(xs: Column, ys: Column, size: int, x: Column) -> Column:
    """Value at x between the boundaries; that of the first or last one outside."""
    at = search(xs, size, x)
    x0, x1, y0, y1 = F.get(xs, at - 1), F.get(xs, at), F.get(ys, at - 1), F.get(ys, at)
    return F.when(at == 0, F.get(ys, F.lit(0))).when(x1.isNull() | (x == x0), y0).otherwise(y0 + (y1 - y0) * (x - x0) / (x1 - x0))


@dataclass
class IsotonicFit:
    """Boundaries ``(x, y)`` by rising x, linear in between."""

    boundaries: DataFrame
    n: int
    low: float | None
    high: float | None
    few: int = FEW
    _small: tuple[list[float], list[float]] | None = None

    @classmethod
    def of(cls, boundaries: DataFrame, few: int = FEW) -> IsotonicFit:
        r = boundaries.agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
        return cls(boundaries, r["n"], r["low"], r["high"], few)

    def write(self, path: str) -> None:
        self.boundaries.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsotonicFit:
        return cls.of(spark.read.parquet(path))

    def small(self) -> tuple[list[float], list[float]]:
        """The boundaries on the driver, for at most ``few`` of them."""
        if self._small is None:
            got = sorted(map(tuple, self.boundaries.collect()))
            self._small = [p[0] for p in got], [p[1] for p in got]
        return self._small

    def cells(self) -> tuple[list[float], DataFrame, int]:
        """First x of each cell (at most ``few``), cells ``(_cell, _xs, _ys)`` with the first boundary of the next, and their
        largest size."""
        size = max(min(CELL, self.few), -(-self.n // self.few))
        ranked = running_totals(self.boundaries.withColumn("one", F.lit(1).cast("bigint")), "x", ["one"])
        rank = F.col("cum_one") - 1
        cell = F.floor(rank / size).cast("int")
        both = F.when((rank % size == 0) & (rank > 0), F.array(cell - 1, cell)).otherwise(F.array(cell))
        rows = ranked.select(F.explode(both).alias("_cell"), F.struct("x", "y").alias("p"))
        table = materialize(rows.groupBy("_cell").agg(F.sort_array(F.collect_list("p")).alias("p")).select(
            "_cell", F.col("p.x").alias("_xs"), F.col("p.y").alias("_ys")), "isotonic-cells")
        edges = [r[0] for r in table.select(F.get("_xs", F.lit(0)).alias("x")).orderBy("_cell").collect()]
        return edges, table, size + 1

    def values(self, df: DataFrame, x: str, out: str) -> DataFrame:
        """``df`` with the fitted value at x (NULL for NULL and NaN)."""
        v = F.col("_at")
        known = v.isNotNull() & ~F.isnan(v)
        src = df.withColumn("_at", F.col(x).cast("double"))
        if self.n <= self.few:
            xs, ys = self.small()
            found = _interpolated(double_array(xs), double_array(ys), self.n, v) if xs else F.lit(None).cast("double")
            return src.withColumn(out, F.when(known, found)).drop("_at")
        edges, table, size = self.cells()
        cell = F.when(known, F.greatest(search(double_array(edges), len(edges), v) - 1, F.lit(0)))
        joined = src.withColumn("_cell", cell).join(table, "_cell", "left")
        return joined.withColumn(out, F.when(known, _interpolated(F.col("_xs"), F.col("_ys"), size, v))).drop("_at", "_cell", "_xs", "_ys")


def fit(df: DataFrame, x: str, y: str, weight: str | None = None, block_rows: int = BLOCK_ROWS, few: int = FEW) -> IsotonicFit:
    """Increasing isotonic regression of y on x; equal x pooled. Without points no boundaries."""
    pts = materialize(points(df, x, y, weight), "isotonic-points")
    blocks = max(1, -(-pts.count() // block_rows))
    local = pts.repartitionByRange(blocks, "lo").sortWithinPartitions("lo").mapInPandas(_pool_partition, _STRETCH)
    pooled = local if blocks == 1 else _merged(materialize(local, "isotonic-blocks"), block_rows)
    ends = pooled.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x"), (F.col("s") / F.col("w")).alias("y"))
    return IsotonicFit.of(materialize(ends, "isotonic-boundaries"), few)
