"""Command line for the whole workflow (WF1), for ``spark-submit``:

    spark-submit --py-files riskspark.zip --conf spark.checkpoint.dir=hdfs:///shared/ckpt \\
        riskspark/cli.py --data hdfs:///raw/loans/*.csv.gz --output-dir hdfs:///scorecards/run-1

Options come from the settings described in ``riskspark.config`` (the LGD options have defaults of
their own, 0.45 / 0.70; K13). Chart options are accepted and ignored: charts are not drawn, their
data tables are written instead.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from riskspark.config import SETTINGS, ScorecardConfig
from riskspark.plans import workflow
from riskspark.sources import io


# Options beside those of the settings (interface).
CHART_OPTIONS = ("--no-save-plots", "--show-plots")


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    """One option for each setting that has a help text, named and typed like the setting."""
    p = argparse.ArgumentParser(description="Credit scorecard workflow on Spark")
    for s in SETTINGS:
        if s.help:
            p.add_argument(s.option, dest=s.name, type=type(s.default), help=s.help,
                           default=s.default if s.cli_default is None else s.cli_default)
    p.add_argument("--sample-size", type=int, help="seeded sample of this many rows")
    for name in CHART_OPTIONS:
        p.add_argument(name, action="store_true", help="accepted, without effect: charts are not drawn")
    return p.parse_args(argv)


def config_from_args(args: argparse.Namespace) -> ScorecardConfig:
    return ScorecardConfig(**{s.name: getattr(args, s.name) for s in SETTINGS if s.help})


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse_args(argv)
    cfg = config_from_args(args)
    spark = spark or SparkSession.builder.appName("riskspark").getOrCreate()
    raw = io.load_raw_data(spark, cfg.data_path, sample_size=args.sample_size, random_state=cfg.random_state,
                           key=cfg.key_col)
    results = workflow.run(spark, cfg, raw)
    workflow.save_artifacts(spark, results, cfg.output_dir, cfg)
    summary = workflow.summary(results).first().asDict()
    for r in results["scenario_summary"].collect():
        summary[f"optimal_cutoff[{r['Scenario']}]"] = r["optimal_cutoff"]
        summary[f"max_profit[{r['Scenario']}]"] = r["max_profit"]
    print(json.dumps(summary, indent=2, default=str))
    return summary


if __name__ == "__main__":
    main()
