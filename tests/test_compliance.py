"""Static checks of the library source: no local checkpoints, no cross joins, no Python UDFs."""

import pathlib

SRC = pathlib.Path(__file__).resolve().parents[1] / "riskspark"


def _code():
    for p in SRC.rglob("*.py"):
        if "llm" not in p.parts:  # an optional subpackage with tests of its own
            yield p, p.read_text()


def test_no_local_checkpoint_cross_join_or_python_udf():
    banned = ["localCheckpoint", "crossJoin(", "F.udf(", "@udf", "pandas_udf", "mapInPandas", "applyInPandas", ".rdd.map"]
    for p, text in _code():
        for b in banned:
            if p.name in ("isotonic.py", "tree.py") and b in ("mapInPandas", "applyInPandas"):
                continue  # stacks of pooled stretches and convex hulls, in Arrow batches
            assert b not in text, f"{b} in {p.name}"


def test_checkpoints_use_the_session_folder():
    # every module that checkpoints makes sure the shared folder is set first
    for p, text in _code():
        if ".checkpoint(" in text and p.name not in ("session.py",):
            assert "checkpoint_dir(" in text, p.name
