"""Catalogue: sources and sinks (A1-A8); each query writes under the shared
checkpoint folder, reads the result back through the library's readers and
reports checks that the oracle computes from the tables directly."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.exprs import hash32_sql, sig as ssig
from flowlens.functions.stats import held
from flowlens.operators import evaluate as G
from flowlens.operators import split as E
from flowlens.plans.q_evaluate import conf_sql, metrics_sql
from flowlens.plans.q_project import cic_flows, clean_6g_rates
from flowlens.plans.registry import query
from flowlens.plans.sqlkit import sig
from flowlens.plans.views import FIXED_NOW, view
from flowlens.session import scratch_path
from flowlens.sources import io as A

F5 = ("flows_5g",)
PL = ("prediction_log",)
SCAN_COLS = "UniqueID BIGINT, Dur DOUBLE, TotPkts DOUBLE, Load DOUBLE, Proto STRING, predicted STRING, Label STRING"
NOW_SQL = f"TIMESTAMP '{FIXED_NOW}'"


@query("scan_csv", f"""
SELECT count(*) AS n_rows, CAST(sum(TotPkts) AS DOUBLE) AS sum_pkts, {sig('avg(Load)')} AS mean_load,
 count(*) - count(Dur) AS null_dur, count(DISTINCT Proto) AS n_proto FROM flows_5g""", F5)
def q_scan_csv(spark, sf):
    """A1: CSV flow scan with header and an explicit schema (written, then read back)."""
    cols = [x.split()[0] for x in SCAN_COLS.split(", ")]
    path = scratch_path(spark, "scan_csv")
    A.write_table(view(spark, sf, "flows_5g").select(*cols), path, "csv")
    d = A.read_flows(spark, path, SCAN_COLS)
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("TotPkts").alias("sum_pkts"),
                 ssig(F.avg("Load")).alias("mean_load"), (F.count(F.lit(1)) - F.count("Dur")).alias("null_dur"),
                 F.countDistinct("Proto").alias("n_proto"))


SLICES = {"eMBB": "1:eMBB", "mMTC": "2:mMTC", "URLLC": "3:URLLC"}


@query("load_family", """
SELECT 'Global' AS dataset, count(*) AS n_rows, 7 AS n_columns FROM flows_5g
UNION ALL SELECT 'eMBB', count(*), 7 FROM flows_5g WHERE predicted = '1:eMBB'
UNION ALL SELECT 'mMTC', count(*), 7 FROM flows_5g WHERE predicted = '2:mMTC'
UNION ALL SELECT 'URLLC', count(*), 7 FROM flows_5g WHERE predicted = '3:URLLC'""", F5)
def q_load_family(spark, sf):
    """A2: load the per-dataset files that exist (an absent one is skipped) with shapes."""
    base = scratch_path(spark, "family")
    cols = [x.split()[0] for x in SCAN_COLS.split(", ")]
    with held(view(spark, sf, "flows_5g"), *map(F.col, cols)) as df:               # four files of one join
        A.write_table(df, f"{base}/Global", "csv")
        for name, code in SLICES.items():
            A.write_table(df.where(F.col("predicted") == code), f"{base}/{name}", "csv")
    fam, _found = A.load_family(spark, base, ["Global", *SLICES, "Extra"], SCAN_COLS)
    return A.family_shapes(fam)


def _logged(spark, sf):
    path = scratch_path(spark, "prediction_log")
    A.append_log(A.log_records(view(spark, sf, "prediction_log")), path)
    return path


@query("append_log", "SELECT CAST(ts AS DATE) AS dt, count(*) AS n, CAST(sum(n_rows) AS BIGINT) AS rows FROM prediction_log GROUP BY ALL", PL)
def q_append_log(spark, sf):
    """A5: append the prediction log as JSON partitioned by UTC day; round-trip counts per day."""
    path = _logged(spark, sf)
    back = spark.read.schema(A.LOG_SCHEMA).json(path)
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("n_rows").alias("rows"))


@query("read_logs", f"""
SELECT CAST(request_id AS VARCHAR) AS request_id, ts, schema_name AS schema, CAST(n_rows AS BIGINT) AS n_rows, attack_rate, mean_probability
FROM prediction_log WHERE ts >= {NOW_SQL} - INTERVAL 7 DAYS""", PL)
def q_read_logs(spark, sf):
    """A3: trailing 7-day read of the JSON log with day-partition pruning and defaults."""
    path = _logged(spark, sf)
    return A.read_logs(spark, path, 7, FIXED_NOW)


@query("recent_predictions", f"SELECT * FROM prediction_log WHERE ts >= {NOW_SQL} - INTERVAL 7 DAYS ORDER BY ts DESC", PL)
def q_recent_predictions(spark, sf):
    """A4: trailing-window read, newest first."""
    return A.recent_predictions(view(spark, sf, "prediction_log"), FIXED_NOW, 7)


@query("export_clean", f"""
WITH c AS (SELECT coalesce(CASE WHEN isnan(flow_bytes_s) OR abs(flow_bytes_s) = 'Infinity'::DOUBLE THEN NULL ELSE flow_bytes_s END, 0.0) AS fb,
  CAST(CASE WHEN isnan(flow_bytes_s) OR abs(flow_bytes_s) = 'Infinity'::DOUBLE OR flow_bytes_s IS NULL THEN 1 ELSE 0 END AS INT) AS fbm,
  flow_duration FROM flows_6g WHERE Label IS NOT NULL)
SELECT count(*) AS n_rows, {sig('sum(fb)', 8)} AS sum_bytes_s, CAST(sum(fbm) AS BIGINT) AS n_missing, {sig('avg(flow_duration)')} AS mean_duration FROM c""",
       ("flows_6g",))
def q_export_clean(spark, sf):
    """Export the cleaned 6G table as CSV with header and read it back."""
    df = clean_6g_rates(cic_flows(spark, sf))
    path = scratch_path(spark, "export_clean")
    A.write_table(df, path, "csv")
    back = A.read_flows(spark, path, df.schema)
    return back.agg(F.count(F.lit(1)).alias("n_rows"), ssig(F.sum("`Flow Bytes/s`"), 8).alias("sum_bytes_s"),
                    F.sum("`Flow Bytes/s_was_missing`").cast("long").alias("n_missing"),
                    ssig(F.avg("`Flow Duration`")).alias("mean_duration"))


@query("baseline_stats", f"""
WITH sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {hash32_sql('id')}, id, score, domain)
   <= floor((count(*) OVER (PARTITION BY y) * 80 + 50) / 100) THEN 'train' ELSE 'test' END AS split,
  CAST(score >= 0.5 AS INT) AS pred FROM scored),
te AS (SELECT * FROM sp WHERE split = 'test'),
m AS ({metrics_sql(conf_sql('te', 'y', 'pred'))}),
rk AS (SELECT s, pos, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tpc, sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fpc,
  sum(pos) OVER () AS P FROM (SELECT score AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM te GROUP BY score)),
ap AS (SELECT sum((pos / P) * (tpc / (tpc + fpc))) AS pr_auc FROM rk),
tr AS (SELECT avg(CAST(y AS DOUBLE)) AS attack_rate_train, count(*) AS n_train_rows FROM sp WHERE split = 'train')
SELECT 'v1' AS version, 42 AS seed, {sig('f1')} AS test_f1, {sig('recall')} AS test_recall, {sig('pr_auc')} AS test_pr_auc,
 {sig('attack_rate_train')} AS attack_rate_train, n_train_rows FROM m, ap, tr""", ("scored",))
def q_baseline_stats(spark, sf):
    """Baseline document: train attack rate and size, test F1 / recall / PR-AUC."""
    d = G.predictions(E.split_stratified(view(spark, sf, "scored"), "id", "y", 20), "score", 0.5)
    te = d.where("split = 'test'")
    m = G.clf_metrics(te, "y", "pred").select(ssig(F.col("f1")).alias("test_f1"), ssig(F.col("recall")).alias("test_recall"))
    ap = G.average_precision(te, "y", "score").select(F.col("average_precision").alias("test_pr_auc"))
    b = A.baseline_stats(d.where("split = 'train'"), "y", m.crossJoin(ap))
    return b.withColumn("attack_rate_train", ssig(F.col("attack_rate_train")))
