"""The operators with DuckDB SQL, their plans, and their edge cases."""

import os

import duckdb
import pytest

from riskspark.llm import chat_preference, decontaminate, lm_backoff, queries, quality_lines
from tests.conftest import SF_SMALL
from tools.oracle_check import _digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


def same(df, con, sql):
    res = con.execute(sql)
    cols, want = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols) and len(got) == len(want)
    assert _digest(df.columns, got)[1] == _digest(cols, want)[1]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF_SMALL), duck, queries.ORACLES[name])


@pytest.mark.parametrize("name", ["op2_quality_lines", "op5_chat_preference", "op8_decontaminate", "op9_shard_minimax", "op11_mix_threshold"])
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def own_duck(**tables):
    """A DuckDB whose views are these lists of rows (name=(schema, rows))."""
    con = duckdb.connect()
    for name, (schema, rows) in tables.items():
        con.execute(f"CREATE TABLE {name} ({schema})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({','.join('?' * len(rows[0]))})", rows)
    return con


PROSE = "The quick brown fox jumps over the lazy dog near a quiet river bank today. "
TEXTS = [None, "", " ", "\n\n", "one", "two words", PROSE, PROSE * 30, "a b c " * 40, (PROSE + "\n") * 9 + "Home | About | Contact | Help",
         "\n".join(f"Sentence number {i} says something of its own here." for i in range(40)) + "\nAll rights reserved {x}",
         "# * $ % & | < >\x0b\x0c\r\t" * 20, " wide space é漢🙂 " * 60, "x" * 300_000,
         " ".join(f"w{i}" for i in range(30_000)), "\n".join(f"A sentence of some words ends here {i}.{end}" for i, end in enumerate("\x85\u2028\u2029\r\x0b " * 4)),
         "\n".join(f"a line of several words {i}\x85" for i in range(20)), ("word " * 9 + "end.\x85") * 8]


def test_quality_edge_rows(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(6, TEXTS[6])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as n_words", "'q' as quality", "true as kept")
    con = own_duck(documents=("doc_id BIGINT, text VARCHAR", [r for r in rows if r[0] != 6]))
    same(quality_lines.verdicts(df.where("doc_id != 6")), con, quality_lines.ORACLE)
    twice = quality_lines.verdicts(df.where("doc_id = 6")).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    assert quality_lines.verdicts(df.limit(0)).collect() == []


def test_cleaning_removes_failing_lines(spark):
    text = PROSE.strip() * 1 + "\nhome | menu | login | more\n" + PROSE.strip()
    got = quality_lines.judge(spark.createDataFrame([(1, text, 5)], "doc_id int, text string, quality_words int")).first()
    assert got["quality"]["cleaned"] == PROSE.strip() + "\n" + PROSE.strip() and got["quality_words"] == 5


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"


def test_decontamination_edge_rows(spark):
    filler = " ".join(f"f{i}" for i in range(300))
    words = ITEM.split()
    docs = [(1, None), (2, ""), (3, ITEM), (4, f"{filler} {ITEM.upper()}, {filler}"), (5, " ".join(words[:21])), (6, " ".join(words[:12])),
            (7, filler), (8, "short one"), (9, " ".join(words[:10] + ["new"] + words[10:])), (10, f"{filler}\n" + "-".join(words)),
            (10, f"{filler}\n" + "-".join(words)), (11, f"{ITEM} {ITEM} {filler} {ITEM}")]
    items = [(1, ITEM), (2, None), (3, ""), (4, "short one"), (5, "a a a a a a a a a"), (6, filler)]
    con = own_duck(documents=("doc_id BIGINT, text VARCHAR", docs), benchmark=("item_id BIGINT, text VARCHAR", items))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as size", "2 as h")
    b = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "3 as size", "4 as doc_id")
    same(decontaminate.leaks(d, b), con, decontaminate.ORACLE)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(d, b).collect()}
    assert {(3, 1), (4, 1), (5, 1), (8, 4), (10, 1), (11, 1), (7, 6)} <= found and not {(6, 1), (9, 1)} & found
    at = {r["doc_id"]: r["first_word"] for r in decontaminate.contained(d, b).where("item_id = 1").collect()}
    assert at[4] == 300 and at[3] == 0
    assert decontaminate.leaks(d.limit(0), b).collect() == decontaminate.leaks(d, b.limit(0)).collect() == []


def test_decontamination_of_repeated_word_runs(spark):
    items, docs = [], []
    for i, n in enumerate([100, 200, 500, 200]):  # distinct shingles
        for j in range(6):
            key = 10 * i + j
            words = [f"w{key}x{k}" for k in range(n + 4)]
            run = ["De"] * n
            if i == 3:  # the item repeats a shingle itself
                items.append((key, " ".join(words + run[:40])))
                docs.append((key, " ".join(["before"] + words + run[:20] + ["after"] * 9)))
            else:
                items.append((key, " ".join(words)))
                docs.append((key, " ".join(["before"] + words[:-(-n * 91 // 100) + 4] + run)))
    con = own_duck(documents=("doc_id BIGINT, text VARCHAR", docs), benchmark=("item_id BIGINT, text VARCHAR", items))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    same(found, con, decontaminate.ORACLE)
    assert found.count() == len(docs)


def test_windows_meet_the_items_they_were_laid_for_alone(spark, monkeypatch):
    """2,000 items of one length and as many documents: rows of the block join follow the matches, not items x documents."""
    n = 2000
    items = [(i, " ".join(f"i{i}w{k}" for k in range(30))) for i in range(n)]
    docs = [(i, (items[i][1] if i % 20 == 0 else " ".join(f"d{i}w{k}" for k in range(30))) + f" tail{i}") for i in range(n)]
    joined = []
    plain = decontaminate.block_join

    def counted(windows, marks):
        out = plain(windows, marks)
        joined.append((windows.select("doc_id", "item_id").distinct().count(), out.count()))
        return out

    monkeypatch.setattr(decontaminate, "block_join", counted)
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, i) for i in range(0, n, 20)}
    pairs, rows = joined[0]
    assert pairs == n // 20 and rows <= 5 * (decontaminate.RADIUS + 1) * pairs


def test_recall_at_the_similarity_itself(spark):
    """Items of which a document holds exactly as much as a weighted similarity of 0.8 asks: every one is found."""
    items, docs = [], []
    for i in range(400):
        size = 9 * (3 + i % 20)  # shingles; the window shares 8 / 9 of them: 8 / (9 + 9 - 8) = 0.8
        words = [f"i{i}w{k}" for k in range(size + 4)]
        items.append((i, " ".join(words)))
        docs.append((i, " ".join(["lead"] * 3 + words[:size * 8 // 9 + 4] + [f"o{i}x{k}" for k in range(size // 9 + 3)])))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sum(r["doc_id"] == r["item_id"] and abs(r["similarity"] - 0.8) < 1e-6 for r in found) >= 399


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(5)
    base = rnd.getrandbits(64)
    near = []
    for i in range(200):
        x = base
        for bit in rnd.sample(range(64), rnd.randint(0, decontaminate.RADIUS)):
            x ^= 1 << bit
        near.append((i, x - (1 << 64) if x >> 63 else x))
    rows = spark.createDataFrame(near, "id int, f bigint").select("id", decontaminate.blocks().alias("b"))
    mine = spark.createDataFrame([(base - (1 << 64) if base >> 63 else base,)], "f bigint").select(decontaminate.blocks().alias("b"))
    assert rows.join(mine, "b").agg(F.countDistinct("id")).first()[0] == 200


def test_scores_leave_the_document_out(spark):
    docs = [(1, None), (2, "  "), (3, "a b c"), (4, "A b d"), (5, "only here"), (6, "a b c " * 500), (7, "a b c")]
    con = own_duck(documents=("doc_id BIGINT, text VARCHAR", docs))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as block", "2 as n_words", "3 as part")
    same(lm_backoff.rounded(df), con, lm_backoff.ORACLE)
    whole = {r["doc_id"]: r["log_score"] for r in lm_backoff.scores(df).collect()}
    small = {r["doc_id"]: r["log_score"] for r in lm_backoff.scores(df, block_bytes=5, table_bytes=3).collect()}
    assert whole == pytest.approx(small)
    assert lm_backoff.scores(df.limit(0)).collect() == []
    again = spark.createDataFrame(docs + [docs[2]], "doc_id bigint, text string")
    assert lm_backoff.scores(again).where("doc_id = 3").count() == 2


def test_preference_edge_rows(spark):
    schema = "conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR"
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "more"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"),
            (2, 0, "user", None), (2, 0, "user", None), (3, 5, None, "x"), (3, 9, "assistant", "y"), (4, 0, "system", "s"), (4, 0, "user", "u"),
            (4, 1, "assistant", ""), (5, 0, "assistant", ""), (None, 0, "user", "z"), (6, None, "user", "z"), (7, 0, "user", "alone")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as k", "2 as part", "3 as pair_id")
    con = own_duck(conversations=(schema, rows))
    same(chat_preference.pairs(df), con, chat_preference.ORACLE)
    assert chat_preference.pairs(df.limit(0)).collect() == []
    got = chat_preference.assemble(chat_preference.pairs(df)).where("pair_id = 0").first()
    assert got["prompt"] == "<|user|>\nhi<|end|>\n"
    assert got["chosen"] == "<|assistant|>\nyes<|end|>\n" and got["rejected"] == "<|assistant|>\nno<|end|>\n"
    assert [got["chosen"][a:b] for a, b in got["chosen_spans"]] == ["yes<|end|>\n"]
    assert [got["rejected"][a:b] for a, b in got["rejected_spans"]] == ["no<|end|>\n"]


def test_common_prefix_is_the_longest(spark):
    t = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(12)]
    chosen = spark.createDataFrame(t, "pair_id long, turn long, role string, text string")
    other = [*t[:7], (1, 7, "assistant", "else"), *t[8:]]
    got = chat_preference.preference(chosen, spark.createDataFrame(other, "pair_id long, turn long, role string, text string")).collect()
    parts = {p: sorted(r["turn"] for r in got if r["part"] == p) for p in ("prompt", "chosen", "rejected")}
    assert parts == {"prompt": [*range(7)], "chosen": [*range(7, 12)], "rejected": [*range(7, 12)]}
    assert {r["turn"] for r in got if r["learned"]} == {7, 9, 11}
    equal = chat_preference.preference(chosen, chosen).collect()
    assert {r["part"] for r in equal} == {"prompt"} and len(equal) == 12


def test_no_local_checkpoint_cross_join_or_swallowed_import():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[2]
    for p in [*root.joinpath("riskspark", "llm").glob("*.py"), root / "corpus_pipeline.py"]:
        text = p.read_text()
        assert not any(x in text for x in ("localCheckpoint", "crossJoin(", "except ImportError", "except ModuleNotFoundError")), p.name


def test_pipeline_stages_match_sql(spark, duck):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, sql in (("quality rules", f"SELECT doc_id FROM ({quality_lines.ORACLE}) WHERE kept"),
                      ("benchmark decontamination", f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({decontaminate.ORACLE}))")):
        got = {r["doc_id"]: r["text"] for r in stages[name](spark, docs, SF_SMALL).collect()}
        want = {r[0] for r in duck.execute(sql).fetchall()}
        assert set(got) == want and 0 < len(want) < len(text)
        assert all(text[i] == t for i, t in got.items())  # only whole documents go
