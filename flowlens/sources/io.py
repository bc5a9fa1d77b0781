"""Sources and sinks.

* Flow files are read with an explicit schema (no inference pass).
* The prediction log is an append-only JSON table partitioned by ``dt``
  (UTC day); trailing-window reads filter on ``dt`` first (partition
  pruning, one day of slack as in the file-name rule) and then on the
  timestamp, drop malformed lines and default missing fields.
* Writes go under the session's shared checkpoint folder when no target is
  given, never to a machine-local temporary folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.stats import c

LOG_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("summary", T.StructType([
        T.StructField("n_attack_predicted", T.LongType()),
        T.StructField("n_benign_predicted", T.LongType()),
        T.StructField("mean_probability", T.DoubleType()),
        T.StructField("attack_rate", T.DoubleType()),
    ])),
    T.StructField("dt", T.DateType()),
])
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


# A1
def read_flows(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame:
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("mode", "PERMISSIVE").csv(path)
    return r.format(fmt).load(path)


# A6
def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


# A2
def load_family(spark: SparkSession, base_dir: str, names: Sequence[str], schema: T.StructType | str,
                fmt: str = "csv") -> tuple[DataFrame | None, list[str]]:
    """Union the per-dataset files that exist (missing ones are skipped) with a
    ``dataset`` column; returns (frame, names found)."""
    out, found = None, []
    for name in names:
        try:
            d = read_flows(spark, f"{base_dir.rstrip('/')}/{name}", schema, fmt)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":    # an unreadable dataset is an error, an absent one is not
                raise
            continue
        d = d.withColumn("dataset", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
        found.append(name)
    return out, found


def family_shapes(df: DataFrame, dataset: str = "dataset") -> DataFrame:
    ncols = len(df.columns) - 1
    return df.groupBy(c(dataset).alias("dataset")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(ncols))


# A5
def log_records(pred: DataFrame, ts: str = "ts", model_version: str = "v1") -> DataFrame:
    """Shape scored-batch summaries as prediction-log records (nested summary)."""
    t = c(ts).cast("timestamp")
    return pred.select(
        c("request_id").cast("string").alias("request_id"),
        F.date_format(t, ISO_FORMAT).alias("timestamp"), F.lit(model_version).alias("model_version"),
        c("schema_name").alias("schema"), c("n_rows").cast("long").alias("n_rows"),
        F.struct(F.floor(c("n_rows") * c("attack_rate") + F.lit(0.5)).cast("long").alias("n_attack_predicted"),
                 (c("n_rows") - F.floor(c("n_rows") * c("attack_rate") + F.lit(0.5))).cast("long").alias("n_benign_predicted"),
                 c("mean_probability").alias("mean_probability"), c("attack_rate").alias("attack_rate")).alias("summary"),
        F.to_date(t).alias("dt"))


def append_log(records: DataFrame, log_dir: str) -> None:
    """Append records to the JSON log, one partition (folder) per UTC day."""
    records.write.mode("append").partitionBy("dt").json(log_dir)


# A3
def read_logs(spark: SparkSession, log_dir: str, days: int, now: str) -> DataFrame:
    """Entries of the trailing ``days`` days: day partitions >= cutoff - 1 day are
    read, malformed lines dropped, entries older than the cutoff removed,
    missing fields defaulted.  Timestamps may carry an offset; without one they are UTC
    (the session's zone).  A timestamp that cannot be parsed drops its line, an
    empty or missing one keeps it."""
    now_ts = F.lit(now).cast("timestamp")
    cutoff = now_ts - F.make_interval(days=F.lit(days))
    raw = spark.read.schema(LOG_SCHEMA).option("mode", "DROPMALFORMED").json(log_dir)
    raw = raw.where(F.col("dt") >= F.to_date(cutoff - F.expr("INTERVAL 1 DAY")))  # partition pruning
    ts = F.try_to_timestamp(F.col("timestamp"))      # ISO 8601, offset aware
    empty = F.coalesce(F.trim("timestamp"), F.lit("")) == ""
    kept = raw.where(empty | (ts >= cutoff))
    return kept.select(
        F.coalesce("request_id", F.lit("")).alias("request_id"), ts.cast("timestamp_ntz").alias("ts"),
        F.coalesce("schema", F.lit("unknown")).alias("schema"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("summary.attack_rate", F.lit(0.0)).alias("attack_rate"),
        F.coalesce("summary.mean_probability", F.lit(0.0)).alias("mean_probability"))


# A4
def recent_predictions(log: DataFrame, now: str, days: int, ts: str = "ts") -> DataFrame:
    """``WHERE ts >= now - N days ORDER BY ts DESC``."""
    cut = F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(days))
    return log.where(c(ts).cast("timestamp") >= cut).orderBy(c(ts).desc())


# A8
def baseline_stats(train: DataFrame, label: str, metrics: DataFrame, version: str = "v1",
                   seed: int = 42) -> DataFrame:
    """One-row baseline document: version, seed, headline metrics, train attack rate and size."""
    t = train.agg(F.avg(c(label).cast("double")).alias("attack_rate_train"),
                  F.count(F.lit(1)).alias("n_train_rows"))
    return metrics.crossJoin(t).select(F.lit(version).alias("version"), F.lit(seed).alias("seed"), "*")


def to_json_document(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("document"))
