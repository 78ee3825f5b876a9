"""Structured Streaming scoring: WF3 is row-local (projections, literal lookups, a stream-static
join only for very large categoricals), so the batch scoring plan runs unchanged on a stream.

No stateful operator is needed: the reference has no stream, window or late-data semantics; this
module only lets new applications be scored as they arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskspark.config import ScorecardConfig
from riskspark.plans.workflow import score_new_data


def score_stream(spark: SparkSession, cfg: ScorecardConfig, stream: DataFrame, artifacts: dict) -> DataFrame:
    """The WF3 plan applied to a streaming DataFrame."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame (spark.readStream...)")
    return score_new_data(spark, cfg, stream, artifacts)


def start_parquet_scoring(
    spark: SparkSession,
    cfg: ScorecardConfig,
    source_dir: str,
    schema,
    artifacts: dict,
    out_dir: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Read new Parquet files from ``source_dir`` and append scores to ``out_dir`` (exactly once
    through the checkpoint location, which must be on shared storage)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = score_stream(spark, cfg, reader.parquet(source_dir), artifacts)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint_location).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(out_dir)
