"""Sources and sinks (SRC1, SRC2, SNK1-SNK3)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from riskspark.operators import ranks
from riskspark.session import at_end_delete, checkpoint_dir

_NON_SPLITTABLE = (".gz", ".gzip", ".zst", ".zstd")


# Texts that mean "missing" in a CSV file (the usual defaults of CSV readers).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
             "NaN", "None", "n/a", "nan", "null")
_NUMBER, _WHOLE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$", r"^\s*[+-]?\d{1,18}\s*$"


def na_to_null(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """NULL for every text that is one of the tokens."""
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(list(tokens)), F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def infer_numbers(df: DataFrame) -> DataFrame:
    """Text columns whose values are all numbers become bigint or double; columns without a value
    double. One aggregation over all columns."""
    names = df.columns
    row = df.agg(F.lit(0).alias("_"), *[x for i, c in enumerate(names) for x in (
        F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.count_if(F.col(f"`{c}`").rlike(_NUMBER)).alias(f"d{i}"),
        F.count_if(F.col(f"`{c}`").rlike(_WHOLE)).alias(f"w{i}"))]).first()
    out = []
    for i, c in enumerate(names):
        n, d, w = row[f"n{i}"], row[f"d{i}"], row[f"w{i}"]
        kind = "double" if n == 0 else "bigint" if w == n else "double" if d == n else "string"
        out.append(F.trim(F.col(f"`{c}`")).cast(kind).alias(c) if kind != "string" else F.col(f"`{c}`"))
    return df.select(*out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are SQL NULL: Spark treats NaN as a value (largest, counted in averages)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(~F.isnan(c), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def has_line_ends_in_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field of the CSV files goes over a line end: then some line holds an odd number of quotes (a quote
    within a field is doubled). One pass over the lines, distributed as far as the files can be split."""
    text = spark.read.text(path)
    return not text.where(F.regexp_count("value", F.lit('"')) % 2 == 1).isEmpty()


def load_raw_data(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sample_size: int | None = None,
    random_state: int = 42,
    key: str = "id",
    min_partitions: int | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """SRC1 (+SRC2): CSV with header, doubled quotes and line ends within quotes; compression from the
    extension. Missing-value texts become NULL before types are told: a column is a number if all that
    is left of it are numbers (a given schema is taken instead), NaN becomes NULL. A missing path raises
    FileNotFoundError. A compressed file, and any file read with ``multi_line``, is one split, so it is dealt
    out right after the read. By default ``multi_line`` is used only if a quoted field goes over a line end, which a pass over
    the lines tells; give it to spare that pass."""
    try:
        multi_line = has_line_ends_in_quotes(spark, path) if multi_line is None else multi_line
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"no such CSV file: {path}") from e
        raise
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
    try:
        df = reader.csv(path)
        if schema is None:
            df.schema  # noqa: B018  (forces the path check for inferred schemas)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"no such CSV file: {path}") from e
        raise
    if multi_line or path.endswith(_NON_SPLITTABLE):
        target = min_partitions or spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < target:
            df = df.repartition(target)
    df = na_to_null(df)
    df = nan_to_null(df if schema is not None else infer_numbers(df))
    if sample_size is not None:
        df = sample_rows(df, sample_size, random_state, key)
    return df


def sample_rows(df: DataFrame, n: int, random_state: int = 42, key: str = "id") -> DataFrame:
    """SRC2: n rows uniformly without replacement, seeded: those with the n smallest md5(key || seed); all rows
    if there are no more than n, none for n = 0.

    The n-th smallest hash is found by bucket counts of its leading bits and the sample is a filter on it, so no task
    gathers or sorts the sample. Only rows that share that hash are looked at again: by the whole digest, and rows of one
    key by a hash of the row."""
    if n <= 0:
        return df.limit(0)
    h = F.md5(F.concat_ws("|", F.col(f"`{key}`").cast("string"), F.lit(str(random_state))))
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    rows, chosen = df, []
    # 60 bits of the digest, the rest of it, and a hash of the row for rows of one key
    for image in (F.conv(F.substring(h, 1, 15), 16, 10), F.conv(F.substring(h, 16, 15), 16, 10), F.xxhash64(text)):
        image = image.cast("bigint")
        found = ranks.threshold(rows, image, n)
        if found is None:  # no more rows than asked for
            chosen.append(rows)
            break
        least, before = found
        chosen.append(rows.where(image < F.lit(least)))
        rows, n = rows.where(image == F.lit(least)), n - before
    else:
        chosen.append(rows.limit(n))  # equal rows
    out = chosen[0]
    for part in chosen[1:]:
        out = out.unionByName(part)
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory, deleted when the application ends."""
    return at_end_delete(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")


def write_csv(df: DataFrame, path: str, order_by: Sequence[str] = (), single_file: bool = False) -> str:
    """SNK1: CSV with header, whitespace kept, rows in the order of ``order_by`` across the files. Ask for
    ``single_file`` only for tables of a bounded size (bins, bands, cutoffs)."""
    out = df.orderBy(*order_by) if order_by else df
    out = out.coalesce(1) if single_file else out
    (out.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_decile_report(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """SNK3: read a saved decile table; the bad-rate column may be named ``actual_bad_rate`` or
    ``bad_rate``; returned as ``actual_bad_rate``."""
    df = read_csv(spark, path, schema)
    if "actual_bad_rate" in df.columns:
        return df
    if "bad_rate" in df.columns:
        return df.withColumnRenamed("bad_rate", "actual_bad_rate")
    raise KeyError("decile report has neither actual_bad_rate nor bad_rate")


def save_json(spark: SparkSession, obj: dict, path: str) -> None:
    """Small driver-side artefact (settings, imputation values) as a one-row JSON dataset."""
    spark.createDataFrame([(json.dumps(obj),)], "payload string").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str) -> dict:
    try:
        row = spark.read.text(path).first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no saved artefact under {path}") from e
    return json.loads(row[0])
