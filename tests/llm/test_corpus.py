"""Near-duplicates, sharding, language ID and the pipeline, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import langid_ftrl, minhash_tensor, quality_lines, shard_minimax
from riskspark.llm.common import Stash, components
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_sets(rows, width):
    out = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    return out


def groups(rows, width, percent):
    """Smallest id reachable, by comparing all pairs."""
    sets = word_sets(rows, width)
    label = {i: i for i in sets}
    ids = sorted(sets)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                c = len(a & b)
                if 100 * c >= percent * (len(a) + len(b) - c):
                    x, y = root(i), root(j)
                    label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_groups_equal_all_pairs(spark, width, percent):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rnd = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    for k in range(60):  # a chain of near copies: neighbours are linked, ends are not
        base = list(base)
        base[int(rnd.integers(120))] = f"x{k}"
        rows.append((10_000 + k, " ".join(base)))
    want, sizes = groups(rows, width, percent)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_tensor.near_duplicates(df, width, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(minhash_tensor, "BLOCK_DOCS", 4)
    rnd = np.random.default_rng(2)
    rows = []
    for k in range(40):
        w = [f"w{i}" for i in range(100)]
        for _ in range(2):
            w[int(rnd.integers(100))] = f"x{rnd.integers(1000)}"
        rows.append((k, " ".join(w)))
    want, _ = groups(rows, 3, 85)
    got = minhash_tensor.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("percent,block", [(85, 2048), (80, 2048), (85, 8)])
def test_pairs_under_keys_of_a_looser_smallest_are_found(spark, monkeypatch, percent, block):
    monkeypatch.setattr(minhash_tensor, "BLOCK_DOCS", block)
    rnd = np.random.default_rng(3)
    phrases = [f"p{i}" for i in range(100)]
    # templated texts of 40 of 100 phrases, and behind them copies of the whole template
    rows = [(i, " ".join(rnd.permutation(phrases)[:40])) for i in range(2500)]
    rows += [(10_000, " ".join(phrases)), (10_001, " ".join(phrases[:97])), (10_002, " ".join(phrases[:95] + ["new"]))]
    got = minhash_tensor.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: min(i, 10_000) for i, _ in rows}


@pytest.mark.parametrize("percent", [85, 80])
def test_recall_at_the_similarity_itself(spark, percent):
    """Pairs of exactly the similarity asked, each met by loosely similar texts under its keys: all are found."""
    rnd = np.random.default_rng(6)
    rows = []
    for k in range(150):
        common = [f"c{k}_{i}" for i in range(percent)]
        own = [f"o{k}_{i}" for i in range(100 - percent)]
        half = len(own) // 2  # shared / united = percent / 100
        rows += [(10_000 + 2 * k, " ".join(common + own[:half])), (10_001 + 2 * k, " ".join(common + own[half:]))]
        for i in range(6):  # smaller ids that share keys with them, but too few shingles
            rows.append((10 * k + i, " ".join([*rnd.permutation(common)[:int(percent * 0.62)], *(f"n{k}_{i}_{j}" for j in range(20))])))
    want, _ = groups(rows, 1, percent)
    assert sum(want[10_001 + 2 * k] == 10_000 + 2 * k for k in range(150)) == 150
    got = minhash_tensor.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, percent).collect()
    missed = sum(r["component_id"] != want[r["doc_id"]] for r in got)
    assert missed == 0


def test_loosely_similar_families_reach_the_last_step(spark, monkeypatch):
    """Families whose members are similar by about 0.7 meet under long keys too; what is linked among them is found exactly."""
    monkeypatch.setattr(minhash_tensor, "BLOCK_DOCS", 16)
    seen = []
    plain = minhash_tensor.Comparison.links
    monkeypatch.setattr(minhash_tensor.Comparison, "links", lambda self, m: seen.append(1) or plain(self, m))
    rnd = np.random.default_rng(7)
    rows = []
    for f in range(4):
        base = [f"b{f}_{i}" for i in range(200)]
        for k in range(60):
            w = list(base)
            for i in rnd.choice(200, int(rnd.choice([3, 20, 36])), replace=False):
                w[i] = f"x{f}_{k}_{i}"
            rows.append((int(1000 * f + rnd.permutation(900)[0] * 1000 + k), " ".join(w)))
    rows = list({i: (i, t) for i, t in rows}.values())
    want, _ = groups(rows, 1, 85)
    got = minhash_tensor.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(seen) == 3


def test_texts_of_one_doc_id_belong_together(spark):
    c, d, e = "a b c d e f", "k l m n o p", "u v w x y z"
    rows = [(3, c), (9, c), (9, d), (12, d), (20, e), (20, None), (20, e), (None, d)]
    got = minhash_tensor.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in got) == [
        (-1, 3, True), (3, 3, True), (9, 3, False), (9, 3, False), (12, 3, False), (20, 20, True), (20, 20, True), (20, 20, True)]
    # one doc_id that is the least of two unrelated texts
    got = minhash_tensor.grouped(spark.createDataFrame([(1, c), (1, d), (2, d), (1, c)], "doc_id long, text string"), 3, 85).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(1, 1), (2, 1)} and len({r["linked"] for r in got}) == 2
    docs = spark.createDataFrame([(1, c, 5), (1, d, 6), (2, d, 7), (1, c, 5), (None, c, 8), (None, c, 8), (4, None, 9), (4, None, 9), (4, "", 9)], "doc_id long, text string, id long")
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "", r["id"]) for r in kept) == [(-1, c, 8), (-1, c, 8), (1, c, 5), (1, d, 6), (4, "", 9)]


def test_duplicate_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a b"), (7, "A B"), (8, "a b c"), (9, "a b c"), (9, "a b c"), (None, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as digest", "2 as id", "'x' as component")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_tensor.near_duplicates(df, 3, 85).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 6, False),
                   (8, 1, 8, True), (9, 1, 8, False), (None, 1, 8, True)}
    assert minhash_tensor.near_duplicates(df.limit(0), 3, 85).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 5000), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), Stash(spark, "t")).collect())
    assert got == {i: 0 for i in range(201)} | {k: 1000 for k in range(1000, 1200)}


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, n, c = (low + high) // 2, 1, 0
        for z in sizes:
            if c + z > mid:
                n, c = n + 1, 0
            c += z
        low, high = (low, mid) if n <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("case", ["table", "hot", "few", "nulls"])
def test_shards(spark, case):
    if case == "table":
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    elif case == "hot":
        rows = [(i, "copy " * 40 if i % 3 == 0 else f"text {i} " * (i % 17)) for i in range(900)]
    elif case == "few":
        rows = [(i, f"t{i % 5}") for i in range(20)]
    else:
        rows = [(1, None), (2, ""), (3, None), (4, "x"), (4, "x"), (None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as size", "2 as shard", "3 as g")
    got = shard_minimax.shard(df).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    by_text, by_shard, sizes = {}, {}, {}
    for r in got:
        t = texts[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode()) and r["law"] == "bytes" and r["grown_shard"] is None
        by_text.setdefault(t, set()).add(r["shard"])
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and set(by_shard) <= set(range(16))
    order = {}
    for _, t in rows:
        g = hashlib.md5((t or "").encode()).hexdigest()
        order[g] = order.get(g, 0) + len((t or "").encode()) + 1
    assert max(sizes.values()) == least_capacity([order[g] for g in sorted(order)], 16)


def test_no_shards_of_an_empty_table(spark):
    assert shard_minimax.shard(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid_ftrl.languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang_pred != 'und'")
    assert held.count() > 100
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.where("score < 0 or score > 1").count() == 0
    right = got.where("held_out").agg(F.avg("score")).first()[0]
    assert right > 0.9  # calibrated: about as sure as it is right


def test_language_edge_rows(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(i, t, "xx" if i % 2 else "yy") for i, t in enumerate(["aa bb ab", "éé çç éç"] * 40)]
    rows += [(900, None, "xx"), (901, "", "xx"), (902, "12 !?", None), (903, "ab", None), (903, "ab", None), (None, "ab", "xx"), (904, "ab " * 50_000, None)]
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 as score", "2 as key")
    got = langid_ftrl.languages(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (900, 901, 902))
    assert by[903]["lang_pred"] == "yy" and by[904]["lang_pred"] == "yy"
    nothing = langid_ftrl.languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    one = langid_ftrl.languages(df.where("lang = 'xx'")).collect()
    assert {r["lang_pred"] for r in one} <= {"xx", "und"}
    assert langid_ftrl.languages(df.limit(0)).collect() == []


def test_penalty_keeps_weights_sparse_and_rows_separable():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        y = i % 3
        at = np.unique(np.r_[rng.integers(0, 50, 5), 1000 + y])
        rows.append((at, np.ones(len(at)) / np.sqrt(len(at)), y))
    w = langid_ftrl.ftrl(rows, 3)
    assert all((v @ w[a]).argmax() == y for a, v, y in rows)
    assert (w != 0).mean() < 0.01


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 500)
    z = 30 * (np.eye(3)[y] * (rng.random((500, 1)) < 0.8) + rng.random((500, 3)) * 0.2)
    t = langid_ftrl.temperature(z, y)

    def loss(t):
        return -np.log(np.maximum(langid_ftrl.softmax(z / t)[np.arange(500), y], 1e-12)).mean()

    assert loss(t) <= min(loss(x) for x in (0.5, 1.0, 2.0, 5.0, 15.0)) + 1e-6


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("kept", F.lit(7)).withColumn("size", F.lit("s"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 34")], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    stash = Stash(spark, "test-pipeline")
    before = stash.put(docs)
    seen = [before]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stash.put(stage(spark, seen[-1], SF_SMALL)))
    for part in seen[1:5]:
        assert part.columns == docs.columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and not {-1, -2, -3} & ids[1]
    kept = {r["doc_id"] for r in quality_lines.verdicts(seen[1].select("doc_id", "text")).where("kept").collect()}
    assert ids[2] == kept
    rows = [(r["doc_id"], r["text"]) for r in seen[2].collect()]
    label, _ = groups(rows, 5, 80)
    assert ids[3] == set(label.values())
    bench = [re.findall(r"[^\W_]+", r["text"].lower()) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    whole = {i for i, t in ((r["doc_id"], " " + " ".join(re.findall(r"[^\W_]+", r["text"].lower())) + " ") for r in seen[3].collect())
             if any(f" {' '.join(b)} " in t for b in bench)}
    assert whole and not whole & ids[4]  # every whole item is found
    assert len(ids[3] - ids[4]) < 0.2 * len(ids[3]) and ids[5] == ids[4]
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in out.collect()} == ids[5]


def test_language_predictions_take_arrow_batches(spark, monkeypatch):
    """No batch of texts is turned into a pandas column of Python strings."""
    def refused(*args, **kwargs):
        raise AssertionError("predictions hold a batch as pandas column")

    monkeypatch.setattr(F, "pandas_udf", refused)
    weights = np.zeros((1 << langid_ftrl.BITS, 2))
    weights[langid_ftrl.ngrams("abc")] = [[1.0, -1.0]]
    model = langid_ftrl.Model(["en", "fr"], np.ones(1 << langid_ftrl.BITS), weights, 1.0)
    docs = spark.createDataFrame([(1, "abc"), (2, None), (3, "12 3"), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid_ftrl.predict(docs, model).collect()}
    assert got == {k: model.predict(t) for k, t in [(1, "abc"), (2, None), (3, "12 3"), (4, "")]}
    assert got[1][0] == "en" and got[2] == ("und", 0.0)
