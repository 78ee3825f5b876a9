"""The correctness gate at sf0.001: every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import _digest
from riskspark.plans import registry as catalog
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()
NAMES = sorted(catalog.ORACLES)  # those of the corpus operators have tests of their own


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from riskspark.sources.fixtures import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(sdf.columns, srows)[0] == _digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns


def test_every_query_has_a_key_shape():
    import re

    for name in entry.queries().keys() - {"pipeline"}:
        assert re.fullmatch(r"[a-z]+[0-9]+_[a-z0-9_]+", name), name
