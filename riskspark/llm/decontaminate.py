"""Benchmark decontamination by SimHash of item-sized windows.

A benchmark item of L words has its shingles (five words each; a shorter item is one shingle). A
document contains it if a window of the document with as many shingles has a weighted Jaccard
similarity of at least 0.8 to it, weights being the number of times a shingle occurs.

1. Where an item's shingles occur in a document is found in one pass over the exploded
   shingles, joined to the (few) item shingles.
2. A window that is similar enough to an item holds a known least number of such places of that item. Windows of the item's
   size are laid at each such place that has enough of them ahead: dropping the shingles before the first place
   and adding as many behind never lowers the similarity, so no other window need be looked at, and no item but
   those that a window was laid for.
3. Each window and item gets a 64-bit SimHash. Its features are the occurrences, each shingle with its
   running number in the window, so that the weighted similarity is the plain one of two sets of features
   and a shingle that occurs often does not turn many bits at once. Fingerprints are cut into ``RADIUS + 1`` blocks; two
   within the radius agree in one block at least, so an equi-join on (item, block, value) finds all of
   them. A radius as wide as 0.8 asks for has narrow blocks, which by themselves part little: what keeps the join small is
   that a window carries the items of step 2. The radius is wide enough for the similarity: 0.8 means a cosine of 0.89 and 9.7 differing
   bits on average; more than 23 have a probability below 1e-5 for a window as long as the item. Documents
   shorter than the item may have an even number of shingles against an odd one: 3.5e-4 at worst (4 and 5).
4. Candidates within the radius are verified by their exact weighted similarity.

Everything is DataFrame functions. The hit rows are only those of shingles that items hold, so a
passage which a third of the documents share costs rows in proportion to those documents. Items are
broadcast up to ``BROADCAST_ROWS`` shingles; beyond that the join is left to the optimiser.

Words are runs of letters and digits, lower-cased. Null or empty texts and items contain nothing and
match nothing. Repeated rows of a document count once, and rows of one doc_id with different texts are
looked at one by one; repeated items (equal item_id) are one item with all their shingles. Rows without
an id are left out, as nothing could name them; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Stash, only

WIDTH, PERCENT, RADIUS = 5, 80, 23
BROADCAST_ROWS = 1_000_000
_LANE = 0x0000000100000001


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def n_shingles(n: Column) -> Column:
    """Shingles of a text of n words."""
    return F.when(n == 0, 0).otherwise(F.greatest(n - (WIDTH - 1), F.lit(1)))


def shingle(w: Column, at: Column) -> Column:
    """Hash of the shingle that begins at a word (null words stand behind a short text's end)."""
    return F.xxhash64(*[F.get(w, at + k) for k in range(WIDTH)])


def occurrences(counted: DataFrame) -> DataFrame:
    """A row for each of the ``c`` occurrences of a shingle ``h``, with a hash of its own."""
    return counted.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("c").cast("int")))).withColumn("h", F.xxhash64("h", "k"))


def fingerprint(rows: DataFrame, by: list[str]) -> DataFrame:
    """SimHash of each group's column ``h``, every row a vote: one sum adds two bits' votes."""
    votes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(_LANE))).alias(f"v{j}") for j in range(32)]
    sums = rows.groupBy(*by).agg(F.count("*").alias("n"), *votes)
    bits = None
    for j in range(32):
        for half in (0, 1):
            count = F.shiftrightunsigned(f"v{j}", 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
            bit = F.when(2 * count > F.col("n"), F.lit(1 << (j + 32 * half) if j + 32 * half < 63 else -(1 << 63))).otherwise(F.lit(0))
            bit = bit.cast("bigint")
            bits = bit if bits is None else bits.bitwiseOR(bit)
    return sums.select(*by, "n", bits.alias("f"))


def blocks(radius: int = RADIUS) -> Column:
    """(block number, value) of a fingerprint ``f`` cut into radius + 1 runs of bits."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.explode(F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("f", a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
        for i, (a, b) in enumerate(zip(edges, edges[1:]))]))


def block_join(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Windows and the items they were laid for that agree in a block."""
    return windows.join(items, ["item_id", "block", "value"])


def contained(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, percent: int = PERCENT,
              stash: Stash | None = None) -> DataFrame:
    """``(doc_id, item_id, first_word, shared, united)`` of every document and item it contains: the most
    similar window's first word (the smallest, if several are), and its shared and united weights."""
    stash = stash or Stash(docs.sparkSession, "decontaminate")
    docs = only(docs, doc_id="bigint", text="string").where("doc_id is not null").withColumn("t", F.xxhash64("text"))
    items = only(benchmark, item_id="bigint", text="string").where("item_id is not null").withColumn("w", words(F.col("text")))
    items = items.withColumn("len", F.size("w")).where("len > 0")
    grams = items.select("item_id", "len", "w", F.explode(F.sequence(F.lit(0), n_shingles(F.col("len")) - 1)).alias("p")).select(
        "item_id", n_shingles(F.col("len")).alias("size"), shingle(F.col("w"), F.col("p")).alias("h"))
    grams = stash.put(grams)
    item_rows = grams.groupBy("item_id", "h").agg(F.count("*").alias("c"))
    # one size for an item that is given more than once with different texts: all its shingles
    sizes = grams.groupBy("item_id").agg(F.count("*").cast("int").alias("size"))
    wanted = grams.select("item_id", "h").distinct().join(sizes, "item_id").select("h", "item_id", "size")
    small = grams.count() <= BROADCAST_ROWS
    if small:
        wanted = F.broadcast(wanted)

    shingled = docs.select("doc_id", "t", words(F.col("text")).alias("w")).withColumn("all", n_shingles(F.size("w"))).where("all > 0")
    hits = shingled.select("doc_id", "t", "all", "w", F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("p")).select(
        "doc_id", "t", "all", "p", shingle(F.col("w"), F.col("p")).alias("h")).join(wanted, "h").select("doc_id", "t", "all", "item_id", "size", "p")
    places = hits.groupBy("doc_id", "t", "all", "item_id", "size").agg(F.sort_array(F.collect_set("p")).alias("places"))
    held = F.least("all", "size")  # shingles in a window: fewer only if the document has fewer
    need = F.ceil((held + F.col("size")) * percent / (100 + percent)).cast("int")
    places = places.withColumn("held", held).withColumn("need", need).where("size(places) >= need")
    starts = F.transform(
        F.filter("places", lambda x, i: F.get("places", i + F.col("need") - 1) < x + F.col("held")),
        lambda x: F.greatest(F.lit(0), F.least(x, F.col("all") - F.col("held"))))
    # a window is laid once, for all items of its size that may match it
    asked = stash.put(places.select("doc_id", "t", "item_id", "size", "held", F.explode(F.array_distinct(starts)).alias("s")))
    windows = asked.select("doc_id", "t", "size", "held", "s").distinct().groupBy("doc_id", "t").agg(F.collect_list(F.struct("size", "held", "s")).alias("windows"))

    laid = docs.join(windows, ["doc_id", "t"]).select("doc_id", "t", words(F.col("text")).alias("w"), F.explode("windows").alias("x"))
    laid = laid.select("doc_id", "t", "w", "x.size", "x.held", "x.s")
    laid = laid.select("doc_id", "t", "size", "s", "w", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("held") - 1)).alias("p"))
    window = ["doc_id", "t", "size", "s"]
    cells = stash.put(laid.select(*window, "p", shingle(F.col("w"), F.col("p")).alias("h")).distinct())

    counted = cells.groupBy(*window, "h").agg(F.count("*").alias("c"))
    prints = fingerprint(occurrences(counted), window)
    marks = fingerprint(occurrences(item_rows).join(sizes, "item_id"), ["item_id", "size"])
    left = prints.join(asked.select(*window, "item_id"), window).select(*window, "item_id", "f", "n", blocks(radius).alias("b")).select("*", "b.block", "b.value").drop("b")
    right = marks.select("item_id", F.col("f").alias("g"), blocks(radius).alias("b")).select("*", F.col("b.block").alias("block"), F.col("b.value").alias("value")).drop("b", "f")
    near = block_join(left, F.broadcast(right) if small else right).where(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius).select(*window, "n", "item_id").distinct()

    both = near.join(counted, window).join(
        (F.broadcast(item_rows) if small else item_rows).withColumnRenamed("c", "ci"), ["item_id", "h"])
    scored = both.groupBy(*window, "item_id", "n").agg(F.sum(F.least("c", "ci")).alias("shared"))
    scored = scored.withColumn("united", F.col("n") + F.col("size") - F.col("shared")).where(f"100 * shared >= {percent} * united")
    best = F.max(F.struct((F.col("shared") / F.col("united")).alias("r"), (-F.col("s")).alias("s"), "shared", "united")).alias("x")
    return scored.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("x.s")).cast("int").alias("first_word"), "x.shared", "x.united")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query's rows: every document and benchmark item it contains, with the similarity."""
    return contained(docs, benchmark).select(
        "doc_id", "item_id", "shared", "united", F.round(F.col("shared") / F.col("united"), 6).alias("similarity"))


ORACLE = r"""
WITH d AS (SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x != '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x != '') AS w FROM benchmark),
dp AS (SELECT doc_id, w, greatest(len(w) - 4, 1) AS n, unnest(range(0, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0),
ds AS (SELECT doc_id, n, p, array_to_string(w[p + 1 : p + 5], ' ') AS h FROM dp),
ip AS (SELECT item_id, w, greatest(len(w) - 4, 1) AS n, unnest(range(0, greatest(len(w) - 4, 1))) AS p FROM i WHERE len(w) > 0),
its AS (SELECT item_id, n, array_to_string(w[p + 1 : p + 5], ' ') AS h, count(*) AS c FROM ip GROUP BY ALL),
hit AS (SELECT ds.doc_id, its.item_id, ds.n AS dn, its.n AS m, ds.p, ds.h, its.c FROM ds JOIN its USING (h)),
win AS (SELECT DISTINCT doc_id, item_id, dn, m, least(dn, m) AS held, greatest(0, least(p, dn - least(dn, m))) AS s FROM hit),
cnt AS (SELECT win.doc_id, win.item_id, win.s, win.held, win.m, hit.h, hit.c, count(*) AS k FROM win JOIN hit
  ON win.doc_id = hit.doc_id AND win.item_id = hit.item_id AND hit.p >= win.s AND hit.p < win.s + win.held GROUP BY ALL),
sc AS (SELECT doc_id, item_id, s, held + m - sum(least(k, c)) AS united, sum(least(k, c)) AS shared FROM cnt GROUP BY doc_id, item_id, s, held, m),
top AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY shared / united DESC, s) AS r FROM sc WHERE 100 * shared >= 80 * united)
SELECT doc_id, item_id, CAST(shared AS BIGINT) AS shared, CAST(united AS BIGINT) AS united, round(CAST(shared AS DOUBLE) / CAST(united AS DOUBLE), 6) AS similarity
FROM top WHERE r = 1
"""
