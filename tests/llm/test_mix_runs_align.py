"""Mixing, periodic runs and token alignment: brute force, edge rows, plans."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from riskspark.llm import mix_threshold, periodic_runs, queries, token_alignment
from riskspark.llm.common import Stash
from tests.conftest import SF_SMALL
from tests.llm.test_relational import own_duck, same

FIRST, SECOND = queries.public_model("byte_bpe_50k.json"), queries.public_model("piece_bpe_32k.model")
EXTRA = ["*", "'t' as target", "1 as size", "'x' as runs", "2 as key", "3 as pair", "4 as h", "5 as times"]


def frame(spark, rows, source=False):
    schema = "doc_id bigint, text string" + (", source string" if source else "")
    return spark.createDataFrame(rows, schema).selectExpr(*EXTRA)


# --- mixing -----------------------------------------------------------------------------------------------------

def mixed(spark, rows):
    con = own_duck(documents=("doc_id BIGINT, text VARCHAR, source VARCHAR", rows))
    df = mix_threshold.mix(frame(spark, rows, source=True))
    same(df, con, mix_threshold.ORACLE)
    return df.collect()


def test_mix_edge_rows(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * 1 for _ in range(rng.randrange(60))), rng.choice(["a", "a", "a", "B", "é", "", None, "\U0001F600", "￮"]))
            for i in range(600)]
    rows += [(None, "one two", "a"), (None, None, "a"), (7, "", None), (8, None, None), (9, None, "empty source"), (9, "", "empty source")]
    rows += [(700, "a repeated row of seven words here", "B")] * 5 + [(701, "x " * 30_000, "é")]
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    sums: dict = {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        key = (r["source_size"], r["target"])
        sums[key] = sums.get(key, 0) + r["taken"]
    for (size, target), taken in sums.items():
        assert 0 <= target <= 2 * size and abs(taken - target) <= 15_000
    assert sum(t for _, t in sums) == pytest.approx(1.5 * sum(s for s, _ in sums))


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "a b c d e", "s%d" % (0 if i % 3 == 0 else i % 7)) for i in range(4000)]
    sums, of = Counter(), dict((i, s) for i, _, s in rows)
    for r in mixed(spark, rows):
        sums[(of[r["doc_id"]], r["target"])] += r["taken"]
    for (_, target), taken in sums.items():
        assert abs(taken - target) <= 2.5


def test_mix_of_nothing(spark):
    assert mixed(spark, []) == []
    assert [(r["target"], r["taken"]) for r in mixed(spark, [(1, None, "a"), (2, "", None)])] == [(0.0, 0), (0.0, 0)]


def test_targets_stop_at_their_limit_and_the_rest_is_shared_out(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), ("d", 0), (None, 80)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mix_threshold.targets(sizes, Stash(spark, "t")).collect()}
    weights, size = {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}, {"a": 10, "b": 1000, "c": 10, "d": 0, None: 80}
    full: set = set()
    while True:  # plain resharing
        left = 1650 - sum(2 * size[s] for s in full)
        part = {s: left * w / sum(v for k, v in weights.items() if k not in full) for s, w in weights.items() if s not in full}
        over = {s for s, t in part.items() if t > 2 * size[s]}
        if not over:
            break
        full |= over
    assert got == pytest.approx(part | {s: 2 * size[s] for s in full})


# --- runs --------------------------------------------------------------------------------------------------------

def plain_runs(w, least=12):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i) + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def random_words(rng):
    n, letters = rng.choice([0, 1, 11, 12, 13, 30, 64, 150, 400]), rng.choice([1, 2, 3, 5, 60])
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.choice([0, 1, 2])):
        if n:
            at = rng.randrange(n)
            cycle, end = rng.randrange(1, n - at + 1), rng.randrange(at, n + 1)
            w = [x if not at <= i < end else w[at + (i - at) % cycle] for i, x in enumerate(w)]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(11)
    docs = [random_words(rng) for _ in range(800)]
    got = periodic_runs.runs([np.array(w, np.int64) for w in docs])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(w) for w in docs]
    assert sum(map(len, got)) > 300


def test_cover_has_a_shift_for_every_pair():
    covered = set(periodic_runs.COVER)
    for x in range(periodic_runs.MODULUS):
        for y in range(periodic_runs.MODULUS):
            d = int(periodic_runs._SHIFT[x, y])
            assert (x + d) % periodic_runs.MODULUS in covered and (y + d) % periodic_runs.MODULUS in covered


def test_extensions_equal_plain_comparison():
    rng = random.Random(2)
    w = [random_words(rng) for _ in range(40)]
    joined = np.array([x for k, d in enumerate(w) for x in [*d, 1000 + k]], np.int64)
    doc = np.repeat(np.arange(40), [len(d) + 1 for d in w])
    lce = periodic_runs.Extensions(joined, doc, max(map(len, w)))
    pairs = [(a, b) for a in rng.choices(range(len(joined)), k=3000) for b in [a + rng.randrange(1, 90)] if b < len(joined) and doc[a] == doc[b]]
    got = lce.between(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    for (a, b), g in zip(pairs, got):
        n = 0
        while joined[a + n] == joined[b + n]:
            n += 1
        assert n == g


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digests(doc_id, text):
    w = (text or "").encode().split()
    w = [x.decode() for x in w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = plain_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(((-m, s, q) for s, m, q in found), default=None)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, n, len(found), *top, digest("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rng = random.Random(8)
    odd = [None, "", " \n", "one", "x " * 500, "a b c " * 40 + "d", " " + "é b " * 30, "same " * 12, "same " * 11, "\x1f \x85 " * 20]
    rows = [(1000 + i, t) for i, t in enumerate(odd * 12)] + [(None, "q " * 30), (1, "r s " * 9), (1, "r s " * 9)]
    rows += [(5000 + i, " ".join(f"w{x}" for x in random_words(rng))) for i in range(150)]
    rows += [tuple(r) for r in docs.collect()]
    got = [tuple(r) for r in periodic_runs.digests(frame(spark, rows)).collect()]
    want = [plain_digests(*r) for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert periodic_runs.digests(frame(spark, rows[:1]).limit(0)).collect() == []


def test_runs_of_a_long_text(spark):
    text = " ".join(f"w{i % 7000}" for i in range(60_000)) + " end"
    got = periodic_runs.periodic_runs(frame(spark, [(1, text)]).withColumn("offset", periodic_runs.F.lit(None)).withColumn("cycle", periodic_runs.F.lit(None))).first()
    assert [tuple(r) for r in got["runs"]] == [(0, 60_000, 7000)] and got["collapsed"].split() == [f"w{i}" for i in range(7000)] + ["end"]


# --- alignment -----------------------------------------------------------------------------------------------------

def plain_alignment(rows):
    """Whole texts through both libraries, without any cutting or keeping."""
    pair = token_alignment.Pair(FIRST, SECOND)
    texts, links = {}, Counter()
    for _, text in rows:
        if not text:
            continue
        a = pair.a.encode(" " + text, add_special_tokens=False).ids
        b = pair.b.encode(text)
        x, y = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
        if not b"".join(x) == b"".join(y) == (" " + text).encode():
            continue
        end_a, end_b = np.cumsum([len(t) for t in x]), np.cumsum([len(t) for t in y])
        both = sorted(set(end_a) & set(end_b))
        groups, met, last = [], [], 0
        for e in both:
            ga, gb = (ids[np.searchsorted(end, last, "right"):np.searchsorted(end, e, "right")] for ids, end in ((a, end_a), (b, end_b)))
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            met.append((ga[-1], gb[-1]))
            last = e
        texts[text] = (len(a), len(b), groups, met)
        links.update(met)
    best: dict = {}
    for (_, b), n in links.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc_id, text in rows:
        if text not in texts:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, met = texts[text]
        out.append((doc_id, n_a, n_b, len(groups), len(met), sum(links[m] == best[m[1]] for m in met), sum(links[m] for m in met),
                    digest(";".join(groups))))
    return out


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a b c", "x\ty z\n\n w", "it's don't 's", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b c", "▁",
       "漢字かな 🙂🙂 é", "é ​ x", "\x00 a \x01", "\x1c a \x85 b", "tab\t tab", "end \n", "  x 　 y", "9 99 999 1,000", "... !!!  ???",
       "x" * 30_000, "ab " * 9000, "﻿bom", "�"]


def test_alignment_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(60)
    rng = random.Random(4)
    mixed_ = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "漢", "'s", "1", ".", " ", "\t", "▁" if k % 9 == 0 else "b"]) for _ in range(80)) for k in range(150)]
    rows = [(i, t) for i, t in enumerate(ODD + mixed_)] + [(3, ODD[4]), (None, "null id"), (None, "null id")] + [tuple(r) for r in docs.collect()]
    got = [tuple(r) for r in token_alignment.digests(frame(spark, rows), FIRST, SECOND).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(plain_alignment(rows), key=key)
    assert token_alignment.digests(frame(spark, rows[:1]).limit(0), FIRST, SECOND).collect() == []
    assert [tuple(r) for r in token_alignment.digests(frame(spark, [(1, None)]), FIRST, SECOND).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_pairs_of_the_corpus(spark):
    rows = [(1, "the cat"), (2, "the cat"), (3, "the dog"), (4, "▁")]
    keyed, texts, pairs = token_alignment.alignment(frame(spark, rows), FIRST, SECOND)
    assert keyed.count() == 4 and {r["times"]: r["n_links"] for r in texts.where("n_links > 0").collect()} == {2: 2, 1: 2}
    got = sorted(r["links"] for r in pairs.collect())
    assert got == [1, 2, 3] and all(r["best"] for r in pairs.collect())


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_hot_join_is_a_plain_join(spark, hot):
    rows = spark.createDataFrame([(k, i) for k, n in enumerate([50, 10, 3, 1, 1]) for i in range(n)], "k int, i int")
    table = rows.groupBy("k").count().where("k != 3")
    got = token_alignment.join_hot(rows, table, "k", "count", Stash(spark, "t"), hot)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(table, "k").collect()))
