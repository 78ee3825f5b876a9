from pyspark.sql import functions as F

from riskspark.config import ScorecardConfig
from riskspark.plans import workflow as WF
from riskspark.sources import fixtures as fx
from riskspark.sources import io
from riskspark.streaming import scoring as ST
from tests.conftest import SF_SMALL

CFG = ScorecardConfig()


def test_workflow_save_load_rescore_and_stream(spark):
    res = WF.run(spark, CFG, fx.loans(spark, SF_SMALL))
    summ = WF.summary(res).first()
    assert 0.5 < summ["auc"] <= 1.0 and summ["n_features"] >= 1
    assert res["cutoff_simulation"].count() == 2 * 55
    assert res["scenario_summary"].count() == 2
    # split is complete and disjoint
    a = res["_artifacts"]
    parts = {r["split"]: r["count"] for r in a["encoded"].groupBy("split").count().collect()}
    assert set(parts) == {"val", "test"}
    # save -> load -> rescore gives the same scores
    out = WF.save_artifacts(spark, res, io.scratch_path(spark, "t-scorecard"), CFG)
    art = WF.load_artifacts(spark, out)
    assert art["selected"] == a["selected"]
    assert art["model"].coefficients == a["model"].coefficients and art["model"].intercept == a["intercept"]
    test_enc = a["encoded"].where(F.col("split") == "test")
    again = WF.score(test_enc, CFG, art["intercept"], art["coefficients"], art["isotonic"], ["id"])
    before = res["scored"].select("id", F.col("score").alias("s0"), F.col("p_good").alias("p0"))
    diff = again.join(before, "id").where((F.col("score") != F.col("s0")) | (F.abs(F.col("p_good") - F.col("p0")) > 1e-12))
    assert diff.count() == 0
    # streaming scoring equals batch scoring of the same rows
    loans = fx.loans(spark, SF_SMALL)
    batch = WF.score_new_data(spark, CFG, loans, art)
    src = io.scratch_path(spark, "t-incoming")
    loans.write.parquet(src)
    dst = io.scratch_path(spark, "t-scored")
    q = ST.start_parquet_scoring(spark, CFG, src, loans.schema, art, dst, io.scratch_path(spark, "t-ckpt"))
    q.awaitTermination()
    streamed = spark.read.parquet(dst)
    assert streamed.count() == batch.count()
    assert streamed.select("id", "score").exceptAll(batch.select("id", "score")).count() == 0


def test_missing_file_raises(spark):
    import pytest

    with pytest.raises(FileNotFoundError):
        io.load_raw_data(spark, "/nonexistent/loans.csv.gz")
    with pytest.raises(FileNotFoundError):
        WF.load_artifacts(spark, "/nonexistent/scorecard")


def test_cli_runs_on_a_csv(spark):
    from riskspark import cli

    src = io.scratch_path(spark, "t-cli-csv")
    (fx.loans(spark, SF_SMALL).write.option("header", True).option("compression", "gzip")
        .option("ignoreLeadingWhiteSpace", False).csv(src))
    out = io.scratch_path(spark, "t-cli-out")
    summary = cli.main(["--data", src, "--output-dir", out, "--sample-size", "1200"], spark=spark)
    assert summary["n_features"] >= 1
    assert any(k.startswith("optimal_cutoff[Baseline (LGD=45%)") for k in summary)
    assert spark.read.option("header", True).csv(f"{out}/decile_table").count() > 0


def test_csv_with_quotes_line_ends_and_missing_texts(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('id,annual_inc,desc,emp_length,grade\n1,50000.5,"He said ""yes"",\nthen left",10+ years,A\n'
                    '2,NA,plain,n/a,NULL\n3,70000,"a, b",< 1 year,B\n4,,None,2 years,nan\n')
    df = io.load_raw_data(spark, str(path))
    assert dict(df.dtypes) == {"id": "bigint", "annual_inc": "double", "desc": "string", "emp_length": "string", "grade": "string"}
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 4 and rows[1]["desc"] == 'He said "yes",\nthen left'
    assert rows[2]["annual_inc"] is None and rows[2]["emp_length"] is None and rows[2]["grade"] is None and rows[4]["desc"] is None
    import pandas as pd

    want = pd.read_csv(path)
    assert [None if pd.isna(x) else x for x in want["annual_inc"]] == [rows[i]["annual_inc"] for i in (1, 2, 3, 4)]
    assert [None if pd.isna(x) else x for x in want["desc"]] == [rows[i]["desc"] for i in (1, 2, 3, 4)]


def test_tables_of_a_block_are_deleted_but_those_kept(spark):
    import pytest

    from riskspark.session import materialize, temporary_tables

    with temporary_tables(spark) as keep:
        kept, gone = keep(materialize(spark.range(3), "kept")), materialize(spark.range(4), "gone")
        assert gone.count() == 4
    assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(gone._written_to)


def test_csv_rows_keep_their_order(spark, tmp_path):
    path = io.write_csv(spark.range(500).repartition(7), str(tmp_path / "t"), ["id"], single_file=True)
    assert [r["id"] for r in io.read_csv(spark, path).collect()] == [*range(500)]


def test_files_are_split_unless_a_field_goes_over_a_line_end(spark, tmp_path):
    plain, long = tmp_path / "plain.csv", tmp_path / "long.csv"
    plain.write_text('id,note\n1,"a ""quoted"" word, and more"\n2,\n')
    long.write_text('id,note\n1,"two\nlines"\n2,x\n')
    assert not io.has_line_ends_in_quotes(spark, str(plain)) and io.has_line_ends_in_quotes(spark, str(long))
    assert sorted(map(tuple, io.load_raw_data(spark, str(plain)).collect())) == [(1, 'a "quoted" word, and more'), (2, None)]
    assert sorted(map(tuple, io.load_raw_data(spark, str(long)).collect())) == [(1, "two\nlines"), (2, "x")]
