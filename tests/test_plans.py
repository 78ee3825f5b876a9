"""Physical-plan properties the design relies on (checked on the formatted plans)."""

import contextlib
import io as _io

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_sweeps_and_buckets_have_no_pair_joins(spark):
    q = entry.queries()
    for name in ("pol2_cutoff_sweep", "pol10_lgd_scenarios", "pol4_policy_presets", "pol6_bucket_breakdown", "pol5_simulator_sweep"):
        text = plan(q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_column_pruning_reaches_the_scan(spark):
    text = plan(entry.queries()["pol10_lgd_scenarios"](spark, SF_SMALL))
    assert "ReadSchema: struct<target:int,pd:double,score:int>" in text
    text = plan(entry.queries()["evl5_calibration_metrics"](spark, SF_SMALL))
    assert "ReadSchema: struct<target:int,raw_good:double>" in text


def test_split_windows_are_partitioned(spark):
    import re

    text = plan(entry.queries()["spl1_stratified_split"](spark, SF_SMALL))
    rank = [line for line in text.splitlines() if "row_number()" in line]
    # the rank window is partitioned by class and hash prefix, never by class alone
    assert rank and all(re.search(r"\], \[loan_status_binary#\d+, _p#\d+\], \[_h#", line) for line in rank)


def test_running_totals_never_order_a_whole_group(spark):
    from riskspark.operators.cumulative import running_totals

    df = spark.createDataFrame([(f"g{v % 2}", float(v), 1) for v in range(500)], "g string, v double, a long")
    text = plan(running_totals(df, "v", ["a"], ["g"], block_rows=100))
    import re

    ordered = re.findall(r"\], \[([^\]]*)\], \[v#", text)  # partition keys of windows ordered by the value
    assert ordered and all("_blk#" in x for x in ordered)


def test_running_totals_take_first_keys_from_block_totals(spark):
    from riskspark.operators.cumulative import running_totals

    df = spark.createDataFrame([(f"g{v % 2}", float(v), 1) for v in range(50)], "g string, v double, a long")
    out = running_totals(df, "v", ["a"], ["g"], with_next=True, block_rows=10)
    assert "row_number" not in plan(out)
    assert {(r["g"], r["v"]): r["next_v"] for r in out.collect()} == {(f"g{v % 2}", float(v)): float(v + 2) if v < 48 else None for v in range(50)}


def test_woe_totals_use_no_window(spark):
    from riskspark.operators import woe as WO

    df = spark.createDataFrame([(f"c{i % 9}", i % 2) for i in range(100)], "s string, y int")
    assert "Window" not in plan(WO.fit_woe(df, "y", None, ["s"]))
