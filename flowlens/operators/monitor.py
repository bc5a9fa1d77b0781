"""Promotion and monitoring over run tables and the prediction log.

All operators are grouped aggregations, time-window aggregations or
``max_by`` picks; time windows use Spark's ``window`` function so the same
expressions run unchanged in Structured Streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.exprs import sig
from flowlens.functions.stats import c

# ---- fixed values ----------------------------------------------------------
MIN_F1, MIN_RECALL, MIN_PR_AUC = 0.90, 0.95, 0.92
LATENCY_BUCKETS = [0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
RATE_WINDOW_SECONDS = 300
# ---------------------------------------------------------------------------


def js_round(x: Column) -> Column:
    """JavaScript Math.round: floor(x + 0.5)."""
    return F.floor(x + F.lit(0.5))


# H7
def promotion_gate(runs: DataFrame, f1: str = "f1", recall: str = "recall", pr_auc: str = "pr_auc",
                   min_f1: float = MIN_F1, min_recall: float = MIN_RECALL, min_pr_auc: float = MIN_PR_AUC) -> DataFrame:
    checks = [
        F.when(c(f1) < min_f1, F.format_string(f"f1 is %.4f, at least {min_f1} needed", F.round(c(f1), 4))),
        F.when(c(recall) < min_recall, F.format_string(f"recall is %.4f, at least {min_recall} needed", F.round(c(recall), 4))),
        F.when(c(pr_auc) < min_pr_auc, F.format_string(f"pr_auc is %.4f, at least {min_pr_auc} needed", F.round(c(pr_auc), 4))),
    ]
    fails = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return runs.withColumn("failures", fails).withColumn("promote", F.size("failures") == 0)


# H8
def latest_run(runs: DataFrame, experiment: str = "experiment", start: str = "start_time",
               run_id: str = "run_id", metrics: Sequence[str] = ("f1", "recall", "pr_auc")) -> DataFrame:
    """Newest run per experiment (ties -> larger run id) with its metrics."""
    pick = F.max_by(F.struct(*[c(m).alias(m) for m in metrics], c(run_id).alias(run_id), c(start).alias(start)),
                    F.struct(c(start), c(run_id)))
    return runs.groupBy(c(experiment).alias(experiment)).agg(pick.alias("r")).select(experiment, "r.*")


# H9
def daily_totals(log: DataFrame, ts: str = "ts", n_rows: str = "n_rows", rate: str = "attack_rate") -> DataFrame:
    day = F.date_trunc("day", c(ts).cast("timestamp"))
    return log.groupBy(day.cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"), F.sum(c(n_rows)).cast("long").alias("rows"),
        F.sum(js_round(c(n_rows) * c(rate))).cast("long").alias("attacks"))


# H10
def history_search(log: DataFrame, schema: str | None, term: str | None,
                   search_cols: Sequence[str], schema_col: str = "schema_name",
                   n_rows: str = "n_rows", rate: str = "attack_rate") -> DataFrame:
    d = log
    if schema and schema != "all":
        d = d.where(c(schema_col) == schema)
    if term:
        t = term.lower()
        cond = None
        for x in search_cols:
            e = F.coalesce(F.lower(c(x).cast("string")).contains(t), F.lit(False))
            cond = e if cond is None else (cond | e)
        d = d.where(cond)
    schemas = log.agg(F.array_sort(F.collect_set(c(schema_col))).alias("schemas"))  # distinct schema names
    tot = d.agg(F.count(F.lit(1)).alias("runs"), F.coalesce(F.sum(c(n_rows)), F.lit(0)).cast("long").alias("rows"),
                F.coalesce(F.sum(js_round(c(n_rows) * c(rate))), F.lit(0)).cast("long").alias("attacks"),
                F.coalesce(F.avg(c(rate)), F.lit(0.0)).alias("avg_rate"))
    return tot.crossJoin(schemas).select("runs", "rows", "attacks", sig(F.col("avg_rate")).alias("avg_rate"), "schemas")


# H11
def request_rate(log: DataFrame, ts: str = "ts", by: Sequence[str] = ("schema_name", "status"),
                 window: str = "1 minute") -> DataFrame:
    w = F.window(c(ts).cast("timestamp"), window)
    return log.groupBy(w.alias("w"), *[c(b) for b in by]).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), *by, "n")


# H12
def latency_buckets(log: DataFrame, latency: str = "latency_s", ts: str = "ts", by: str = "schema_name",
                    window: str = "5 minutes", bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative bucket counts (le = bound, +inf last) per window and group."""
    w = F.window(c(ts).cast("timestamp"), window)
    aggs = [F.sum((c(latency) <= F.lit(b)).cast("long")).alias(f"le_{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count(F.lit(1)).alias("le_inf"))
    return log.groupBy(w.alias("w"), c(by).alias(by)).agg(*aggs)


def histogram_quantile(buckets: DataFrame, q: float = 0.95, by: str = "schema_name",
                       bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Prometheus-style quantile from cumulative buckets: linear inside the bucket
    that reaches rank q * total; the +inf bucket returns the largest finite bound."""
    tot = F.col("le_inf")
    rank = F.lit(q) * tot
    est = F.lit(bounds[-1])
    for i in range(len(bounds) - 1, -1, -1):
        lo_b = 0.0 if i == 0 else bounds[i - 1]
        lo_n = F.lit(0) if i == 0 else F.col(f"le_{i - 1}")
        hi_n = F.col(f"le_{i}")
        val = F.lit(lo_b) + F.lit(bounds[i] - lo_b) * (rank - lo_n) / (hi_n - lo_n)
        est = F.when(hi_n >= rank, val).otherwise(est)
    return buckets.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), by, "le_inf",
                          sig(F.when(tot > 0, est)).alias(f"p{int(q * 100)}"))


# H13
def last_value(log: DataFrame, value: str, ts: str = "ts", tie: str = "request_id",
               by: str = "schema_name") -> DataFrame:
    return log.groupBy(c(by).alias(by)).agg(F.max_by(c(value), F.struct(c(ts), c(tie))).alias(f"last_{value}"))


# H14
def rows_total(log: DataFrame, n_rows: str = "n_rows", by: Sequence[str] = ()) -> DataFrame:
    return log.groupBy(*[c(b) for b in by]).agg(F.sum(c(n_rows)).cast("long").alias("rows_total"))


# H15
def attack_benign_rate(log: DataFrame, ts: str = "ts", n_rows: str = "n_rows", rate: str = "attack_rate",
                       window_seconds: int = RATE_WINDOW_SECONDS) -> DataFrame:
    w = F.window(c(ts).cast("timestamp"), f"{window_seconds} seconds")
    attacks = js_round(c(n_rows) * c(rate))
    g = log.groupBy(w.alias("w")).agg(F.sum(attacks).alias("a"), F.sum(c(n_rows)).alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    sig(F.col("a") / F.lit(float(window_seconds))).alias("attack_rows_per_s"),
                    sig((F.col("n") - F.col("a")) / F.lit(float(window_seconds))).alias("benign_rows_per_s"))


# H16
def model_age(runs: DataFrame, now: str, start: str = "start_time") -> DataFrame:
    last = runs.agg(F.max(c(start).cast("timestamp")).alias("last_run"))
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("last_run")
    return last.select(F.col("last_run").cast("timestamp_ntz").alias("last_run"), age.cast("long").alias("age_seconds"))


# H17
def hourly_trend(log: DataFrame, now: str, hours: int = 24, ts: str = "ts", n_rows: str = "n_rows",
                 rate: str = "attack_rate") -> DataFrame:
    """Per hour of the last ``hours`` hours: total, attack and benign rows; empty
    hours come from an hour spine (``hours`` rows)."""
    spark = log.sparkSession
    end = F.date_trunc("hour", F.lit(now).cast("timestamp"))
    spine = spark.range(1, hours + 1).select((end - F.make_interval(hours=F.col("id").cast("int"))).alias("hour"))
    lo = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    d = log.where((c(ts).cast("timestamp") >= lo) & (c(ts).cast("timestamp") < F.lit(now).cast("timestamp")))
    attacks = js_round(c(n_rows) * c(rate))
    g = d.groupBy(F.date_trunc("hour", c(ts).cast("timestamp")).alias("hour")).agg(
        F.sum(c(n_rows)).alias("total"), F.sum(attacks).alias("attack"))
    out = F.broadcast(spine).join(g, "hour", "left")  # spine: `hours` rows
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), F.coalesce("total", F.lit(0)).cast("long").alias("total"),
                      F.coalesce("attack", F.lit(0)).cast("long").alias("attack"),
                      (F.coalesce("total", F.lit(0)) - F.coalesce("attack", F.lit(0))).cast("long").alias("benign"))


# H18
def confidence_histogram(df: DataFrame, conf: str) -> DataFrame:
    """Confidence bins 0.5-1.0 by 0.1 (clamped into 5 bins), with counts."""
    b = F.least(F.lit(4), F.greatest(F.lit(0), F.floor((c(conf) - F.lit(0.5)) * F.lit(10)))).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        "bin", (F.lit(0.5) + F.col("bin") / F.lit(10.0)).alias("lo"), "n")
