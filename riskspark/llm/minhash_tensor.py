"""MinHash near-duplicate groups by tensored banding.

A document is the set of its distinct word shingles, as 64-bit hashes. Two small collections of hash
groups are computed for it; a table key is the pair of one group of the first and one of the second
collection. So ``tables ** 2`` keys of ``2 * rows`` minhashes each cost only ``2 * tables * rows``
minhashes. A pair of similarity s shares a key with probability ``(1 - (1 - s**rows)**tables) ** 2``:
0.99998 at 0.85 and 0.9996 at 0.8 with the defaults, and more above.

Steps:

1. Texts with equal sets fall into one class (a digest of the sorted set), and only one text of a class goes on.
2. Each class is tied to the smallest one under each of its keys (a minimum that is pre-aggregated, joined back to
   the keys that more than one class has). Ties whose minhashes agree too rarely for the similarity asked are not
   looked at further: a true pair fails that test with a probability below 1e-9. The others are compared exactly on the full
   sets, the smallest class against those tied to it, so the work is linear in the ties.
3. What the confirmed links connect is a group. Where a tie leaves two groups apart, the pair that met under its keys
   may be neither's link to the smallest, so all classes tied to that smallest get a second set of longer keys
   (``LONG_ROWS`` minhashes, as many keys as miss a pair at the similarity asked with a probability of at most ``MISSED``),
   under which loosely similar texts hardly meet. There they are tied and compared in the same way.
4. What then is still apart under a smallest is compared with all that hang together with it: every class that is
   not of the largest group of its cluster against all of the cluster, exactly.
5. Rows of one doc_id are one document, so the classes of its texts belong together; connected components give the
   smallest doc_id that can be reached.

Comparisons are dealt in blocks of bounded size, each a task of its own; a task hands on no pairs but a spanning
forest of its links. Null texts and texts without words have an empty set and are linked with nothing; a text with
fewer words than a shingle is one shingle. Words are those of ``WORD``, A-Z lower-cased. Repeated rows give
repeated results; rows without doc_id are grouped with nothing that has none, but join the group of their text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Stash, components, only
from riskspark.llm.text_hashes import mix, word_hashes

TABLES, ROWS = 12, 3
#: Minhashes of a key of the second set, and the share of pairs that its keys may miss.
LONG_ROWS, MISSED = 10, 1e-6
#: Documents and shingles that a block of a comparison holds at most (a single document may be longer).
BLOCK_DOCS, BLOCK_SHINGLES = 768, 400_000
#: Columns of the comparison matrix at a time, and documents up to which each is compared on its own instead.
COLUMNS, ALONE = 2048, 4
#: Documents of the left side compared at a time.
LEFT_DOCS = 256
#: Hash values computed at a time.
CELLS = 16_384

def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = word_hashes(text)
    if not len(words):
        return words
    k = min(width, len(words))
    h = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(3) + words[i:len(words) - k + 1 + i] + np.uint64(i + 1))
    return np.unique(h)


@lru_cache(maxsize=8)
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    odd = np.random.default_rng(4).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd[:, None], (odd >> np.uint64(7))[:, None]


def minima(sets: np.ndarray, n: int) -> np.ndarray:
    """n minhashes of a set, several hash functions at a time."""
    odd, turned = _multipliers(n)
    step = max(1, CELLS // max(1, len(sets)))
    return mix(np.concatenate([((sets[None, :] ^ turned[i:i + step]) * odd[i:i + step]).min(axis=1) for i in range(0, n, step)]))


@dataclass(frozen=True)
class Tensored:
    """Keys of every group of one collection paired with every group of the other."""

    tables: int
    rows: int

    @property
    def minhashes(self) -> int:
        return 2 * self.tables * self.rows

    def keys(self, signature: np.ndarray) -> np.ndarray:
        groups = np.zeros((2, self.tables), np.uint64)
        parts = signature.reshape(2, self.tables, self.rows)
        for i in range(self.rows):
            groups = mix(groups * np.uint64(5) + parts[:, :, i])
        pair = np.arange(self.tables**2, dtype=np.uint64)
        return mix(np.repeat(groups[0], self.tables) * np.uint64(3) + np.tile(groups[1], self.tables) + pair * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


@dataclass(frozen=True)
class Long:
    """Keys of many minhashes of their own."""

    count: int
    rows: int

    @classmethod
    def for_similarity(cls, s: float) -> Long:
        return cls(math.ceil(math.log(MISSED) / math.log1p(-(s**LONG_ROWS))), LONG_ROWS)

    @property
    def minhashes(self) -> int:
        return self.count * self.rows

    def keys(self, signature: np.ndarray) -> np.ndarray:
        parts = signature.reshape(self.count, self.rows)
        out = np.arange(self.count, dtype=np.uint64)
        for i in range(self.rows):
            out = mix(out * np.uint64(5) + parts[:, i])
        return out.view(np.int64)


def least_agreement(similarity: float, n: int) -> int:
    """Minhashes of n that a pair of the similarity has in common but for a probability below 1e-9."""
    total = 0.0
    for k in range(n + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                          + k * math.log(similarity) + (n - k) * math.log1p(-similarity)) if similarity < 1 else float(k == n)
        if total >= 1e-9:
            return k
    return n


def signatures(docs: DataFrame, width: int, bands: Tensored) -> DataFrame:
    """``docs(id, part, text)`` as ``(id, part, n_shingles, digest, signature)``: set size, digest of the set, minhashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                n, digest, sig = [], [], []
                for x in rows.column(2):
                    s = shingles(x.as_py(), width)
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sig.append(minima(s, bands.minhashes).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                    names=["id", "part", "n_shingles", "digest", "signature"])

    return docs.select("id", "part", "text").mapInArrow(run, "id bigint, part bigint, n_shingles bigint, digest binary, signature binary")


def table_keys(signed: DataFrame, bands: Tensored) -> DataFrame:
    """``(id, key)`` rows of ``signed(id, signature)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [bands.keys(np.frombuffer(x.as_py(), np.uint64)) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), [len(k) for k in found])),
                                                  pa.array(np.concatenate(found))], names=["id", "key"])

    return signed.select("id", "signature").mapInArrow(run, "id bigint, key bigint")


def long_signatures(texts: DataFrame, width: int, bands: Long) -> DataFrame:
    """``(id, keys, marks)`` of ``texts(id, text)``: the keys, and the low byte of each minhash, which is all that the test of
    a tie needs (unequal minhashes that agree in it only make the test let more through)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                found = [minima(shingles(x.as_py(), width), bands.minhashes) for x in rows.column(1)]
                keys = pa.array(np.concatenate([bands.keys(x) for x in found]))
                marks = pa.array([(x & np.uint64(255)).astype(np.uint8).tobytes() for x in found], pa.binary())
                edges = pa.array(np.arange(len(found) + 1, dtype=np.int32) * bands.count)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(edges, keys), marks], names=["id", "keys", "marks"])

    return texts.select("id", "text").mapInArrow(run, "id bigint, keys array<bigint>, marks binary")


def tied(key_rows: DataFrame, marks: DataFrame, minhashes: int, similarity: float) -> DataFrame:
    """``(a, b, near)``: classes of ``key_rows(id, key)`` with the smallest one under a key they share, and whether their
    ``marks(id, marks)``, a number of equal bytes for each minhash, agree often enough."""
    low = key_rows.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("most")).where("b < most").select("key", "b")
    ties = key_rows.join(low, "key").where("id != b").select(F.col("id").alias("a"), "b").distinct()
    both = (ties.join(marks.select(F.col("id").alias("a"), F.col("marks").alias("ma")), "a")
            .join(marks.select(F.col("id").alias("b"), F.col("marks").alias("mb")), "b"))
    least = least_agreement(similarity, minhashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                x, y = (np.frombuffer(b"".join(rows.column(i).to_pylist()), np.uint8).reshape(rows.num_rows, minhashes, -1) for i in (2, 3))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array((x == y).all(2).sum(1) >= least)], names=["a", "b", "near"])

    return both.select("a", "b", "ma", "mb").mapInArrow(run, "a bigint, b bigint, near boolean")


def links(ids: np.ndarray, left: np.ndarray, right: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between documents of the two sides (row numbers, which may overlap): pairs with
    ``100 * shared >= percent * united``, counted exactly."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([sets[i] for i in right])
    of_right = np.repeat(np.arange(len(right)), sizes[right])
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while (up := parent.get(i, i)) != i:
            parent[i] = parent.get(up, up)
            i = up
        return i

    out = []
    for at in range(0, len(left), LEFT_DOCS):
        some = left[at:at + LEFT_DOCS]
        shared = common_counts([sets[i] for i in some], flat, of_right, len(right))
        hit = (100 * shared >= percent * (sizes[some][:, None] + sizes[right][None, :] - shared)) & (ids[some][:, None] != ids[right][None, :])
        for i, j in zip(*np.nonzero(hit)):
            x, y = int(ids[some[i]]), int(ids[right[j]])
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((x, y))
    return out


def common_counts(left: list[np.ndarray], flat: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """How many elements each left set shares with each of n right sets, given as their elements and the set of each."""
    common = np.zeros((len(left), n), np.float32)
    if len(left) <= ALONE:
        for k, own in enumerate(left):
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            common[k] = np.bincount(row, weights=own[at] == flat, minlength=n)
        return common.astype(np.int64)
    own = np.unique(np.concatenate(left))  # no other shingle is in an intersection
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    held = own[at] == flat
    row, column = row[held], at[held]
    mine = np.concatenate([np.searchsorted(own, s) for s in left])
    of = np.repeat(np.arange(len(left)), [len(s) for s in left])
    by, mine_by = np.argsort(column, kind="stable"), np.argsort(mine, kind="stable")
    row, column, of, mine = row[by], column[by], of[mine_by], mine[mine_by]
    for low in range(0, len(own), COLUMNS):
        (a, b), (c, d) = np.searchsorted(column, [low, low + COLUMNS]), np.searchsorted(mine, [low, low + COLUMNS])
        x, y = np.zeros((len(left), COLUMNS), np.float32), np.zeros((n, COLUMNS), np.float32)
        x[of[c:d], mine[c:d] - low] = 1
        y[row[a:b], column[a:b] - low] = 1
        common += x @ y.T
    return common.astype(np.int64)


class Comparison:
    """Exact comparisons of classes by their texts."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int, percent: int, stash: Stash) -> None:
        self.docs, self.classes, self.width, self.percent, self.stash = docs, classes, width, percent, stash

    def texts(self, ids: DataFrame) -> DataFrame:
        """``(id, text)`` of the classes ``ids(id)``, one text of each."""
        which = self.classes.join(ids, "id").select("id", "doc_id", "part")
        found = self.docs.join(which, ["doc_id", "part"])
        return found.groupBy("id").agg(F.first("text").alias("text"))  # copies of a row are folded before the shuffle

    def links(self, members: DataFrame) -> DataFrame:
        """Links ``(a, b)`` within the groups of ``members(group, id, everywhere)``, of the members marked ``everywhere`` with
        all members."""
        sized = self.stash.put(members.join(self.classes.select("id", "n_shingles"), "id"))
        groups = sized.groupBy("group").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("s"))
        groups = self.stash.put(groups.withColumn("blocks", F.greatest(F.ceil(F.col("m") / BLOCK_DOCS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")))
        # groups of one block share tasks of about a block's size
        small = groups.where("blocks = 1").agg(F.sum("s")).first()[0] or 0
        lot = F.when(F.col("blocks") == 1, -1 - F.pmod(F.xxhash64("group"), F.lit(int(small // BLOCK_SHINGLES) + 1))).otherwise(F.col("group"))
        home = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        placed = sized.join(groups.select("group", "blocks", lot.alias("lot")), "group").withColumn("home", home)
        block = F.explode(F.when(F.col("everywhere"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("home")))
        dealt = self.texts(sized.select("id").distinct()).join(placed.select("id", "group", "lot", "everywhere", "home", block.alias("block")), "id")
        width, percent = self.width, self.percent

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            kept: dict[int, np.ndarray] = {}  # a class may be in several groups of a lot
            got = []
            for at in rows.groupby("group").indices.values():
                part = rows.iloc[at]
                ids = part["id"].to_numpy()
                for i, t in zip(ids, part["text"]):
                    if i not in kept:
                        kept[i] = shingles(t, width)
                left = np.flatnonzero(part["everywhere"].to_numpy())
                right = np.flatnonzero((part["home"] == part["block"]).to_numpy())
                if len(left) and len(right):
                    got += links(ids, left, right, [kept[i] for i in ids], percent)
            return pd.DataFrame(got, columns=["a", "b"], dtype="int64")

        return dealt.select("id", "group", "lot", "everywhere", "home", "block", "text").groupBy("lot", "block").applyInPandas(run, "a bigint, b bigint")

    def stars(self, ties: DataFrame) -> DataFrame:
        """Links among ``ties(a, b)``, each b with the classes tied to it."""
        centre = ties.select(F.col("b").alias("group"), F.col("b").alias("id"), F.lit(True).alias("everywhere")).distinct()
        return self.links(centre.unionByName(ties.select(F.col("b").alias("group"), F.col("a").alias("id"), F.lit(False).alias("everywhere"))))


def apart(ties: DataFrame, groups: DataFrame, stash: Stash) -> DataFrame:
    """``(a, b)``: all ties of each b that has a tie to a class of another group."""
    of = groups.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    to = groups.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    mixed = ties.join(of, "a", "left").join(to, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("b").distinct()
    return stash.put(ties.join(mixed, "b").select("a", "b"))


def either(ties: DataFrame) -> DataFrame:
    return ties.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def class_links(docs: DataFrame, classes: DataFrame, width: int, percent: int, bands: Tensored, stash: Stash) -> DataFrame:
    """``(id, component)`` of the classes that have links."""
    exact = Comparison(docs, classes, width, percent, stash)
    marks = classes.select("id", F.col("signature").alias("marks"))
    first = stash.put(tied(table_keys(classes, bands), marks, bands.minhashes, percent / 100))
    found = stash.put(exact.stars(first.where("near").select("a", "b")))
    groups = components(found, stash)
    left = apart(first.select("a", "b"), groups, stash)
    if left.isEmpty():
        return groups
    long = Long.for_similarity(percent / 100)
    signed = stash.put(long_signatures(exact.texts(either(left)), width, long))
    second = stash.put(tied(signed.select("id", F.explode("keys").alias("key")), signed.select("id", "marks"), long.minhashes, percent / 100))
    found = found.unionByName(stash.put(exact.stars(second.where("near").select("a", "b"))))
    groups = components(found, stash)
    left = apart(second.select("a", "b"), groups, stash)
    if left.isEmpty():
        return groups
    clusters = stash.put(components(left, stash).withColumnRenamed("component", "group").join(groups, "id", "left").select(
        "id", "group", F.coalesce("component", "id").alias("component")))
    count = clusters.groupBy("group", "component").agg(F.count("*").alias("n"))
    largest = count.groupBy("group").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    members = clusters.join(largest, "group").select("group", "id", (F.col("component") != F.col("largest")).alias("everywhere"))
    return components(found.unionByName(stash.put(exact.links(members))), stash)


def grouped(docs: DataFrame, width: int = 5, percent: int = 80, tables: int = TABLES, rows: int = ROWS, stash: Stash | None = None) -> DataFrame:
    """``(doc_id, part, n_shingles, linked, component_id)`` of ``docs(doc_id, text)``: ``part`` is a hash of the text,
    ``linked`` numbers the texts that hang together by links (null: no set), ``component_id`` is the smallest doc_id
    that links and equal doc_ids reach."""
    stash = stash or Stash(docs.sparkSession, "minhash")
    rows_in = only(docs, doc_id="bigint", text="string").withColumn("part", F.xxhash64("text"))
    bands = Tensored(tables, rows)
    sig = stash.put(signatures(rows_in.withColumnRenamed("doc_id", "id"), width, bands))
    classes = sig.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("without"), F.col("id").alias("doc_id"), "part")).alias("r"),
        F.first("signature").alias("signature"), F.min("n_shingles").alias("n_shingles"))
    classes = stash.put(classes.where("not r.without").select(
        F.monotonically_increasing_id().alias("id"), "r.doc_id", "r.part", "digest", "signature", "n_shingles"))
    groups = class_links(rows_in, classes, width, percent, bands, stash)
    linked = stash.put(classes.select("id", "digest").join(groups, "id", "left").select("digest", F.coalesce("component", "id").alias("linked")))
    named = stash.put(sig.select(F.col("id").alias("doc_id"), "part", "n_shingles", "digest").join(linked, "digest", "left").drop("digest"))
    ids = named.where("doc_id is not null and linked is not null")
    # several texts of one doc_id join their groups
    several = ids.groupBy("doc_id").agg(F.min("linked").alias("a"), F.max("linked").alias("b")).where("a < b").select("doc_id", "a")
    joined = components(ids.join(several, "doc_id").select("a", F.col("linked").alias("b")), stash).withColumnRenamed("id", "linked")
    least = ids.groupBy("linked").agg(F.min("doc_id").alias("least")).join(joined, "linked", "left").withColumn(
        "component", F.coalesce("component", "linked"))
    smallest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    reach = least.select("linked", "component").join(smallest, "component").select("linked", "component_id")
    return named.join(reach, "linked", "left").select(
        "doc_id", "part", "n_shingles", "linked", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, tables: int = TABLES, rows: int = ROWS,
                    stash: Stash | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of ``docs(doc_id, text)``, linked at a similarity of at
    least ``percent`` per cent of shingles of ``width`` words."""
    return grouped(docs, width, percent, tables, rows, stash).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
