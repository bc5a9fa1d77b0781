"""Catalogue: drift (H1-H6) and monitoring / promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.exprs import sig as ssig
from flowlens.operators import clean as C
from flowlens.operators import drift as D
from flowlens.operators import evaluate as G
from flowlens.operators import monitor as M
from flowlens.operators import project as P
from flowlens.plans.q_evaluate import EXPERTS_SQL, with_experts
from flowlens.plans.registry import query
from flowlens.plans.sqlkit import sig
from flowlens.plans.views import FIXED_NOW, view

PL = ("prediction_log",)
CUTOFF = "2024-01-24 00:00:00"  # FIXED_NOW - 7 days
NOW_SQL = f"TIMESTAMP '{FIXED_NOW}'"
CUT_SQL = f"TIMESTAMP '{CUTOFF}'"


def log(spark, sf) -> DataFrame:
    return view(spark, sf, "prediction_log")


def windows(spark, sf):
    d = log(spark, sf)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    return d.where(F.col("ts") < cut), d.where(F.col("ts") >= cut)


BASE_SQL = f"(SELECT * FROM prediction_log WHERE ts < {CUT_SQL})"
CURR_SQL = f"(SELECT * FROM prediction_log WHERE ts >= {CUT_SQL})"
PROBS = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"


def psi_sql(col: str, base=BASE_SQL, curr=CURR_SQL, closed=False) -> str:
    """PSI oracle: deduplicated baseline decile edges, numpy-style bins, 1e-6 guard."""
    inner = "i >= 1 AND i <= (SELECT max(i) FROM e) - 1"
    rng = " AND v >= (SELECT min(e) FROM e) AND v <= (SELECT max(e) FROM e)" if closed else ""
    return f"""e AS (SELECT CAST(row_number() OVER (ORDER BY q) - 1 AS INT) AS i, q AS e FROM
   (SELECT DISTINCT unnest(quantile_cont({col}, {PROBS})) AS q FROM {base} WHERE {col} IS NOT NULL)),
b AS (SELECT side, least((SELECT max(i) FROM e) - 1, (SELECT count(*) FROM e WHERE {inner} AND e <= v)) AS bin FROM
   (SELECT 0 AS side, {col} AS v FROM {base} UNION ALL SELECT 1, {col} FROM {curr}) WHERE v IS NOT NULL{rng}),
spine AS (SELECT CAST(i AS INT) AS bin FROM range((SELECT max(i) FROM e)) t(i)),
cnt AS (SELECT spine.bin, CAST(count(CASE WHEN side = 0 THEN 1 END) AS DOUBLE) AS bn, CAST(count(CASE WHEN side = 1 THEN 1 END) AS DOUBLE) AS cn
   FROM spine LEFT JOIN b ON spine.bin = b.bin GROUP BY spine.bin),
pq AS (SELECT bn / sum(bn) OVER () AS p, cn / sum(cn) OVER () AS q, bn, cn FROM cnt),
terms AS (SELECT CASE WHEN p = 0 AND q = 0 THEN 0.0 ELSE
   (CASE WHEN p = 0 THEN 1e-6 ELSE p END - CASE WHEN q = 0 THEN 1e-6 ELSE q END)
   * ln(CASE WHEN p = 0 THEN 1e-6 ELSE p END / CASE WHEN q = 0 THEN 1e-6 ELSE q END) END AS t, bn, cn FROM pq),
psi AS (SELECT CASE WHEN sum(bn) > 0 AND sum(cn) > 0 THEN sum(t) ELSE 0.0 END AS psi, (SELECT count(*) FROM e) AS n_edges FROM terms)"""


@query("psi", f"WITH {psi_sql('attack_rate')}\nSELECT {sig('psi')} AS psi, CAST(n_edges AS INT) AS n_edges FROM psi", PL)
def q_psi(spark, sf):
    """H1: PSI of the attack rate, baseline window vs the trailing 7 days."""
    base, curr = windows(spark, sf)
    return D.psi(base, curr, "attack_rate").select(ssig(F.col("psi")).alias("psi"), "n_edges")


def ks_sql(col: str, base=BASE_SQL, curr=CURR_SQL) -> str:
    terms = " + ".join(f"2.0 * {(-1) ** (k - 1)} * exp(-2.0 * {k * k} * lam * lam)" for k in range(1, 101))
    return f"""ku AS (SELECT {col} AS v, 1 AS na, 0 AS nb FROM {base} WHERE {col} IS NOT NULL
   UNION ALL SELECT {col}, 0, 1 FROM {curr} WHERE {col} IS NOT NULL),
kcnt AS (SELECT v, sum(na) AS ca, sum(nb) AS cb FROM ku GROUP BY v),
kcum AS (SELECT sum(ca) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS fa, sum(cb) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS fb,
   sum(ca) OVER () AS n_a, sum(cb) OVER () AS n_b FROM kcnt),
ks AS (SELECT max(abs(fa / n_a - fb / n_b)) AS d, CAST(max(n_a) AS BIGINT) AS n_a, CAST(max(n_b) AS BIGINT) AS n_b FROM kcum),
kl AS (SELECT *, (sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b)) + 0.12 + 0.11 / sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b))) * d AS lam FROM ks),
kp AS (SELECT d, n_a, n_b, CASE WHEN lam < 1e-3 THEN 1.0 ELSE least(greatest(0.0 + {terms}, 0.0), 1.0) END AS p FROM kl)"""


@query("ks_statistic", f"WITH {ks_sql('mean_probability')}\nSELECT n_a, n_b, {sig('d')} AS ks_statistic, {sig('p', 6)} AS ks_p_value FROM kp", PL)
def q_ks_statistic(spark, sf):
    """H2: two-sample KS statistic and asymptotic p-value of the mean probability."""
    base, curr = windows(spark, sf)
    k = D.ks_statistic(base, curr, "mean_probability")
    return k.select("n_a", "n_b", ssig(F.col("ks_statistic")).alias("ks_statistic"),
                    ssig(D.ks_pvalue(F.col("ks_statistic"), F.col("n_a").cast("double"), F.col("n_b").cast("double")), 6)
                    .alias("ks_p_value"))


REPORT_SQL = f"""WITH {psi_sql('attack_rate')}, {ks_sql('mean_probability')},
r AS (SELECT count(*) AS n_requests, avg(attack_rate) AS rec FROM {CURR_SQL}),
bs AS (SELECT avg(attack_rate) AS base FROM {BASE_SQL})
SELECT CASE WHEN n_requests = 0 THEN 'no_data' WHEN psi >= 0.2 OR p < 0.05 THEN 'drift_detected' ELSE 'ok' END AS status,
 7 AS window_days, n_requests, {sig('base')} AS baseline_attack_rate, {sig('rec')} AS recent_mean_attack_rate,
 round(psi, 4) AS psi_attack_rate, round(d, 4) AS ks_statistic, round(p, 4) AS ks_p_value,
 list_filter([CASE WHEN psi >= 0.2 THEN printf('attack rate moved: PSI %.3f, limit 0.2', round(psi, 3)) END,
  CASE WHEN p < 0.05 THEN printf('scores moved: KS p-value %.4f, limit 0.05', round(p, 4)) END], lambda x: x IS NOT NULL) AS alerts
FROM r, bs, psi, kp"""


@query("drift_report", REPORT_SQL, PL)
def q_drift_report(spark, sf):
    """H3: drift report (status, recent mean, PSI, KS, alerts) against a real baseline window."""
    base, curr = windows(spark, sf)
    return D.drift_report(base, curr)


FEATS = ["attack_rate", "mean_probability", "latency_s", "n_rows"]


def _feature_drift_sql():
    parts = []
    for f in FEATS:
        parts.append(f"(WITH {psi_sql(f)}, {ks_sql(f)} SELECT '{f}' AS feature, psi, d FROM psi, kp)")
    body = " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts)
    return (f"SELECT feature, {sig('psi')} AS psi, {sig('d')} AS ks_statistic, CASE WHEN psi < 0.1 THEN 'stable' "
            f"WHEN psi < 0.2 THEN 'monitor' ELSE 'alert' END AS band FROM ({body})")


@query("feature_drift", _feature_drift_sql(), PL)
def q_feature_drift(spark, sf):
    """H5 (+H4 bands): PSI and KS per monitored column."""
    base, curr = windows(spark, sf)
    return D.feature_drift(base, curr, FEATS)


SCHEMAS = ("argus", "cic")


def _band_sql(schema: str) -> str:
    base, curr = (x.replace("WHERE", f"WHERE schema_name = '{schema}' AND") for x in (BASE_SQL, CURR_SQL))
    return (f"(WITH {psi_sql('latency_s', base, curr)} SELECT '{schema}' AS schema_name, {sig('psi')} AS psi, "
            "CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.2 THEN 'monitor' ELSE 'alert' END AS band FROM psi)")


@query("drift_band", " UNION ALL ".join(f"SELECT * FROM {_band_sql(x)}" for x in SCHEMAS), PL)
def q_drift_band(spark, sf):
    """H4: PSI band (< 0.1 stable, < 0.2 monitor, else alert) of the latency, per input format."""
    base, curr = windows(spark, sf)
    out = None
    for x in SCHEMAS:
        p = D.psi(base.where(F.col("schema_name") == x), curr.where(F.col("schema_name") == x), "latency_s")
        p = p.select(F.lit(x).alias("schema_name"), ssig(F.col("psi")).alias("psi"), D.drift_band(F.col("psi")).alias("band"))
        out = p if out is None else out.unionByName(p)
    return out


@query("slice_quality", f"""
WITH f AS (SELECT predicted AS slice, CASE WHEN Label = 'Malicious' THEN 1 ELSE 0 END AS y, CAST(State = 'RST' AS INT) AS pred FROM flows_5g),
c AS (SELECT slice, CAST(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp, CAST(sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn
  FROM f GROUP BY slice)
SELECT slice, {sig('coalesce(tp / nullif(tp + fp, 0), 0.0)')} AS precision, {sig('coalesce(tp / nullif(tp + fn, 0), 0.0)')} AS recall FROM c""", ("flows_5g",))
def q_slice_quality(spark, sf):
    """H6: precision / recall per slice of the RST-flag detector on the projected 5G flows."""
    df = C.binarize_label(view(spark, sf, "flows_5g"), "Label", "5g")
    cats = C.fit_categories(df, ["State"])
    oh = C.onehot(df, cats, drop_first=True)
    p = oh.select(F.col("predicted").alias("slice"), "Label", P.flags_5g(oh)["u_rst"].alias("pred"))
    m = G.clf_metrics(p, "Label", "pred", ["slice"])
    return m.select("slice", ssig(F.col("precision")).alias("precision"), ssig(F.col("recall")).alias("recall"))


# ---- evaluation runs (one per domain and ship month) -------------------------
def runs(spark, sf) -> DataFrame:
    """Run table derived by the library: per (domain, month) F1 / recall at 0.5 and PR-AUC."""
    d = view(spark, sf, "scored_ts")
    d = d.withColumn("run_id", F.concat_ws("-", "domain", F.date_format("ts", "yyyy-MM")))
    d = G.predictions(d, "score", 0.5)
    m = G.clf_metrics(d, "y", "pred", ["run_id"]).select("run_id", "f1", "recall")
    ap = G.average_precision(d, "y", "score", ["run_id"]).withColumnRenamed("average_precision", "pr_auc")
    meta = d.groupBy("run_id").agg(F.first("domain").alias("experiment"), F.min("ts").alias("start_time"))
    return meta.join(m, "run_id").join(ap, "run_id")


RUNS_SQL = f"""runs0 AS (SELECT domain || '-' || strftime(ts, '%Y-%m') AS run_id, * FROM scored_ts),
rc AS (SELECT run_id, any_value(domain) AS experiment, min(ts) AS start_time,
  CAST(sum(CASE WHEN y = 1 AND score >= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, CAST(sum(CASE WHEN y = 0 AND score >= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN y = 1 AND score < 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS fn FROM runs0 GROUP BY run_id),
rm AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS pp, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM rc),
rk AS (SELECT run_id, s, pos, neg, sum(pos) OVER (PARTITION BY run_id ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tpc,
  sum(neg) OVER (PARTITION BY run_id ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fpc, sum(pos) OVER (PARTITION BY run_id) AS P
  FROM (SELECT run_id, score AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM runs0 GROUP BY run_id, score)),
ra AS (SELECT run_id, sum((pos / P) * (tpc / (tpc + fpc))) AS pr_auc FROM rk WHERE P > 0 GROUP BY run_id),
runs AS (SELECT rm.run_id, experiment, start_time, coalesce(2 * pp * recall / nullif(pp + recall, 0), 0.0) AS f1, recall, pr_auc
  FROM rm JOIN ra ON rm.run_id = ra.run_id)"""


@query("promotion_gate", f"""WITH {RUNS_SQL}
SELECT run_id, {sig('f1')} AS f1, {sig('recall')} AS recall, {sig('pr_auc')} AS pr_auc,
 list_filter([CASE WHEN f1 < 0.9 THEN printf('f1 is %.4f, at least 0.9 needed', round(f1, 4)) END,
  CASE WHEN recall < 0.95 THEN printf('recall is %.4f, at least 0.95 needed', round(recall, 4)) END,
  CASE WHEN pr_auc < 0.92 THEN printf('pr_auc is %.4f, at least 0.92 needed', round(pr_auc, 4)) END], lambda x: x IS NOT NULL) AS failures,
 f1 >= 0.9 AND recall >= 0.95 AND pr_auc >= 0.92 AS promote FROM runs""", ("scored_ts",))
def q_promotion_gate(spark, sf):
    """H7: promotion gate (F1 >= .90, recall >= .95, PR-AUC >= .92) with failure messages, per run."""
    r = runs(spark, sf).withColumn("pr_auc", F.col("pr_auc").cast("double"))
    g = M.promotion_gate(r)
    return g.select("run_id", *[ssig(F.col(x)).alias(x) for x in ("f1", "recall", "pr_auc")], "failures", "promote")


@query("latest_run", f"""WITH {RUNS_SQL}
SELECT experiment, {sig('arg_max(f1, (start_time, run_id))')} AS f1, {sig('arg_max(recall, (start_time, run_id))')} AS recall,
 {sig('arg_max(pr_auc, (start_time, run_id))')} AS pr_auc, max(run_id) FILTER (WHERE start_time = (SELECT max(start_time) FROM runs r2 WHERE r2.experiment = runs.experiment)) AS run_id,
 max(start_time) AS start_time FROM runs GROUP BY experiment""", ("scored_ts",))
def q_latest_run(spark, sf):
    """H8: newest run per experiment with its metrics."""
    lr = M.latest_run(runs(spark, sf))
    return lr.select("experiment", *[ssig(F.col(x)).alias(x) for x in ("f1", "recall", "pr_auc")], "run_id", "start_time")


@query("model_age", f"""SELECT max(st) AS last_run, CAST(epoch({NOW_SQL}) - epoch(max(st)) AS BIGINT) AS age_seconds
FROM (SELECT min(ts) AS st FROM scored_ts GROUP BY domain, strftime(ts, '%Y-%m'))""",
       ("scored_ts",))
def q_model_age(spark, sf):
    """Model age = fixed now - start of the newest run."""
    starts = view(spark, sf, "scored_ts").groupBy("domain", F.date_format("ts", "yyyy-MM")).agg(F.min("ts").alias("start_time"))
    return M.model_age(starts, FIXED_NOW)


@query("daily_totals", """
SELECT date_trunc('day', ts) AS day, count(*) AS runs, CAST(sum(n_rows) AS BIGINT) AS rows,
 CAST(sum(floor(n_rows * attack_rate + 0.5)) AS BIGINT) AS attacks FROM prediction_log GROUP BY ALL""", PL)
def q_daily_totals(spark, sf):
    """H9: per-day totals: runs, rows and sum of round(rows x rate) (JS rounding)."""
    return M.daily_totals(log(spark, sf))


@query("history_search", f"""
WITH v AS (SELECT * FROM prediction_log WHERE schema_name = 'argus' AND
  (coalesce(contains(lower(CAST(request_id AS VARCHAR)), '12'), false) OR coalesce(contains(lower(status), '12'), false)))
SELECT count(*) AS runs, CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS rows, CAST(coalesce(sum(floor(n_rows * attack_rate + 0.5)), 0) AS BIGINT) AS attacks,
 {sig('coalesce(avg(attack_rate), 0.0)')} AS avg_rate, (SELECT list_sort(list_distinct(list(schema_name))) FROM prediction_log) AS schemas FROM v""", PL)
def q_history_search(spark, sf):
    """Schema filter + case-insensitive substring search; totals, mean rate, distinct schemas."""
    return M.history_search(log(spark, sf), "argus", "12", ["request_id", "status"])


@query("request_rate", """
SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, schema_name, status, count(*) AS n FROM prediction_log GROUP BY ALL""", PL)
def q_request_rate(spark, sf):
    """Request count by 1-minute window, schema and status."""
    return M.request_rate(log(spark, sf))


B = M.LATENCY_BUCKETS


def _p95_sql():
    les = ", ".join(f"CAST(sum(CASE WHEN latency_s <= {b} THEN 1 ELSE 0 END) AS DOUBLE) AS le_{i}" for i, b in enumerate(B))
    est = str(B[-1])
    for i in range(len(B) - 1, -1, -1):
        lo_b = 0.0 if i == 0 else B[i - 1]
        lo_n = "0" if i == 0 else f"le_{i - 1}"
        est = f"CASE WHEN le_{i} >= 0.95 * le_inf THEN {lo_b} + {B[i] - lo_b} * (0.95 * le_inf - {lo_n}) / (le_{i} - {lo_n}) ELSE {est} END"
    return (f"WITH g AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, schema_name, {les}, count(*) AS le_inf "
            f"FROM prediction_log GROUP BY ALL)\nSELECT window_start, schema_name, le_inf, "
            f"{sig(f'CASE WHEN le_inf > 0 THEN {est} END')} AS p95 FROM g")


@query("latency_p95", _p95_sql(), PL)
def q_latency_p95(spark, sf):
    """P95 latency per schema in 5-minute windows from fixed histogram buckets."""
    return M.histogram_quantile(M.latency_buckets(log(spark, sf)), 0.95)


@query("last_attack_rate", """
SELECT schema_name, arg_max(attack_rate, (ts, request_id)) AS last_attack_rate FROM prediction_log GROUP BY schema_name""", PL)
def q_last_attack_rate(spark, sf):
    """Attack rate of the newest batch per schema."""
    return M.last_value(log(spark, sf), "attack_rate")


@query("rows_total", "SELECT schema_name, CAST(sum(n_rows) AS BIGINT) AS rows_total FROM prediction_log GROUP BY schema_name", PL)
def q_rows_total(spark, sf):
    """Total rows processed per schema."""
    return M.rows_total(log(spark, sf), by=["schema_name"])


@query("attack_benign_rate", f"""
WITH g AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, sum(floor(n_rows * attack_rate + 0.5)) AS a, sum(n_rows) AS n
 FROM prediction_log GROUP BY ALL)
SELECT window_start, {sig('a / 300.0')} AS attack_rows_per_s, {sig('(n - a) / 300.0')} AS benign_rows_per_s FROM g""", PL)
def q_attack_benign_rate(spark, sf):
    """Attack vs benign rows per second in 5-minute windows."""
    return M.attack_benign_rate(log(spark, sf))


@query("hourly_trend", f"""
WITH spine AS (SELECT date_trunc('hour', {NOW_SQL}) - to_hours(CAST(i AS BIGINT)) AS hour FROM range(1, 25) t(i)),
g AS (SELECT date_trunc('hour', ts) AS hour, sum(n_rows) AS total, sum(floor(n_rows * attack_rate + 0.5)) AS attack
  FROM prediction_log WHERE ts >= {NOW_SQL} - INTERVAL 24 HOURS AND ts < {NOW_SQL} GROUP BY ALL)
SELECT spine.hour, CAST(coalesce(total, 0) AS BIGINT) AS total, CAST(coalesce(attack, 0) AS BIGINT) AS attack,
 CAST(coalesce(total, 0) - coalesce(attack, 0) AS BIGINT) AS benign FROM spine LEFT JOIN g ON spine.hour = g.hour""", PL)
def q_hourly_trend(spark, sf):
    """Hourly totals of the last 24 h with empty hours filled from an hour spine."""
    return M.hourly_trend(log(spark, sf), FIXED_NOW, 24)


@query("confidence_histogram", EXPERTS_SQL + """
SELECT CAST(least(4, greatest(0, floor((greatest(prob, 1 - prob) - 0.5) * 10))) AS INT) AS bin,
 0.5 + CAST(least(4, greatest(0, floor((greatest(prob, 1 - prob) - 0.5) * 10))) AS INT) / 10.0 AS lo, count(*) AS n FROM ex GROUP BY ALL""", ("scored",))
def q_confidence_histogram(spark, sf):
    """Confidence (max(p, 1-p)) histogram 0.5-1.0 by 0.1, clamped."""
    df = with_experts(spark, sf).withColumn("conf", F.greatest(F.col("prob"), 1 - F.col("prob")))
    return M.confidence_histogram(df, "conf")
