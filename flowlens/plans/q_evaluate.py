"""Catalogue: evaluation (G1-G17) and scoring with given parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.exprs import hash32_sql, sig as ssig
from flowlens.operators import evaluate as G
from flowlens.operators import score as S
from flowlens.operators import split as E
from flowlens.plans.registry import query
from flowlens.plans.sqlkit import sig
from flowlens.plans.views import view

SC = ("scored",)

# Parameters of a given (loaded) model bundle used by the scoring queries:
# five calibrators (a, b) over the raw score, and a linear softmax gate over
# [score, is_domain_F].
CAL = [(4.0, -2.0), (6.0, -3.0), (2.0, -1.0), (8.0, -4.5), (3.0, -1.2)]
GATE_W = [[1.5, -0.5, 0.2, 0.8, -1.0], [0.3, 0.6, -0.4, 0.1, 0.5]]
GATE_B = [0.1, 0.0, -0.1, 0.2, 0.05]
SCORE_COLS = ["s_embb", "s_mmtc", "s_urllc", "s_tcp_ae", "s_udp_ae"]


def scored(spark, sf) -> DataFrame:
    return view(spark, sf, "scored")


def with_experts(spark, sf) -> DataFrame:
    """scored + expert score vector (F10/F11) + gate weights + combined probability."""
    df = scored(spark, sf)
    x = F.col("score")
    isf = (F.col("domain") == "F").cast("double")
    scores = S.expert_score_vector([S.apply_calibrator(x, a, b) for a, b in CAL])
    weights = S.linear_gate([x, isf], GATE_W, GATE_B)
    df = df.withColumn("scores", scores).withColumn("weights", weights)
    return df.withColumn("prob", S.weighted_combine(F.col("weights"), F.col("scores")))


# ---- SQL side of the same model --------------------------------------------
def _cal_sql(a, b):
    return f"1.0 / (1.0 + exp(-({a} * score + {b})))"


def _z_sql(j):
    return f"{GATE_B[j]} + score * {GATE_W[0][j]} + CAST(domain = 'F' AS DOUBLE) * {GATE_W[1][j]}"


EXPERTS_SQL = ("WITH e00 AS (SELECT *, " + ", ".join(f"{_cal_sql(a, b)} AS s{i + 1}" for i, (a, b) in enumerate(CAL))
               + ", " + ", ".join(f"{_z_sql(j)} AS z{j + 1}" for j in range(5)) + " FROM scored),\n"
               "e0 AS (SELECT *, " + ", ".join(f"exp(z{j + 1} - greatest(z1, z2, z3, z4, z5)) AS e{j + 1}" for j in range(5))
               + " FROM e00),\n"
               "e1 AS (SELECT *, " + ", ".join(f"e{j} / (0.0 + e1 + e2 + e3 + e4 + e5) AS w{j}" for j in range(1, 6))
               + " FROM e0),\n"
               "ex AS (SELECT *, 1.0 / (1.0 + exp(-(4.0 * ((0.0 + w1 * s1 + w2 * s2 + w3 * s3 + w4 * s4 + w5 * s5) - 0.5)))) AS prob FROM e1)")


def ranked_sql(src: str, label: str, score: str, by=()) -> str:
    g = ", ".join(by)
    pg = f"PARTITION BY {g} " if by else ""
    lead = f"{g}, " if by else ""
    return f"""(SELECT *, sum(neg) OVER ({pg}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
 sum(pos) OVER ({pg}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
 sum(pos) OVER ({pg.strip()}) AS P, sum(neg) OVER ({pg.strip()}) AS N
 FROM (SELECT {lead}{score} AS s, sum({label}) AS pos, count(*) - sum({label}) AS neg FROM {src} GROUP BY {lead}{score}))"""


def auc_sql(src, label, score, by=()) -> str:
    lead = ", ".join(by) + ", " if by else ""
    grp = "GROUP BY " + ", ".join(by) if by else ""
    return (f"SELECT {lead}CASE WHEN max(P) > 0 AND max(N) > 0 THEN CAST(sum(pos * (2 * (N - fp) + neg)) AS DOUBLE)"
            f" / (2.0 * CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) END AS roc_auc FROM {ranked_sql(src, label, score, by)} {grp}")


def ap_sql(src, label, score, by=()) -> str:
    lead = ", ".join(by) + ", " if by else ""
    grp = "GROUP BY " + ", ".join(by) if by else ""
    return (f"SELECT {lead}{sig('sum((pos / P) * (tp / (tp + fp)))')} AS average_precision "
            f"FROM {ranked_sql(src, label, score, by)} WHERE P > 0 {grp}")


def conf_sql(src, label, pred, by=()) -> str:
    lead = ", ".join(by) + ", " if by else ""
    grp = "GROUP BY " + ", ".join(by) if by else ""
    return (f"SELECT {lead}CAST(sum(CASE WHEN {label} = 1 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,"
            f" CAST(sum(CASE WHEN {label} = 0 AND {pred} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,"
            f" CAST(sum(CASE WHEN {label} = 0 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,"
            f" CAST(sum(CASE WHEN {label} = 1 AND {pred} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn FROM {src} {grp}")


def metrics_sql(conf: str, keep: str = "") -> str:
    p = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0)"
    r = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0)"
    return (f"SELECT {keep}tp, fp, tn, fn, coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + tn + fn, 0), 0.0) AS accuracy,"
            f" {p} AS precision, {r} AS recall, coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0.0) AS f1 FROM ({conf})")


PRED = "(SELECT *, CAST(score >= 0.5 AS INT) AS pred FROM scored)"


def _pred(spark, sf):
    return G.predictions(scored(spark, sf), "score", 0.5)


@query("confusion", conf_sql(PRED, "y", "pred"), SC)
def q_confusion(spark, sf):
    """G1: confusion counts at threshold 0.5."""
    return G.confusion(_pred(spark, sf), "y", "pred")


def _sig_metrics(df, keep=()):
    return df.select(*keep, "tp", "fp", "tn", "fn", *[ssig(F.col(x)).alias(x) for x in ("accuracy", "precision", "recall", "f1")])


def _sig_metrics_sql(inner, keep=""):
    return (f"SELECT {keep}tp, fp, tn, fn, {sig('accuracy')} AS accuracy, {sig('precision')} AS precision, "
            f"{sig('recall')} AS recall, {sig('f1')} AS f1 FROM ({inner})")


@query("clf_metrics", _sig_metrics_sql(metrics_sql(conf_sql(PRED, "y", "pred"))), SC)
def q_clf_metrics(spark, sf):
    """Accuracy, precision, recall, F1 (0 on empty denominators)."""
    return _sig_metrics(G.clf_metrics(_pred(spark, sf), "y", "pred"))


@query("roc_auc", auc_sql("scored", "y", "score"), SC)
def q_roc_auc(spark, sf):
    """Exact ROC-AUC with ties counted half."""
    return G.roc_auc(scored(spark, sf), "y", "score")


@query("average_precision", ap_sql("scored", "y", "score"), SC)
def q_average_precision(spark, sf):
    """Average precision as the step sum over distinct thresholds."""
    return G.average_precision(scored(spark, sf), "y", "score")


@query("roc_curve", f"""SELECT s AS threshold, coalesce(CAST(fp AS DOUBLE) / nullif(N, 0), 0.0) AS fpr,
 coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0) AS tpr FROM {ranked_sql('scored', 'y', 'score')}""", SC)
def q_roc_curve(spark, sf):
    """ROC curve points at every distinct score."""
    return G.roc_curve(scored(spark, sf), "y", "score")


@query("pr_curve", f"""SELECT s AS threshold, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS precision,
 coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0) AS recall FROM {ranked_sql('scored', 'y', 'score')}""", SC)
def q_pr_curve(spark, sf):
    """Precision-recall curve points at every distinct score."""
    return G.pr_curve(scored(spark, sf), "y", "score")


@query("best_threshold", f"""
WITH pr AS (SELECT s AS threshold, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS p,
  coalesce(CAST(tp AS DOUBLE) / nullif(P, 0), 0.0) AS r FROM {ranked_sql('scored', 'y', 'score')}),
f AS (SELECT *, 2 * p * r / (p + r + 1e-8) AS f1 FROM pr ORDER BY f1 DESC, threshold ASC LIMIT 1)
SELECT threshold, {sig('p')} AS precision, {sig('r')} AS recall, {sig('f1')} AS f1 FROM f""", SC)
def q_best_threshold(spark, sf):
    """F1-optimal threshold, ties -> lowest threshold."""
    return G.best_threshold(scored(spark, sf), "y", "score")


SWEEP_VALUES = ", ".join(f"({t})" for t in G.SWEEP)
SWEEP_SQL = f"""
WITH g(threshold) AS (SELECT CAST(v AS DOUBLE) FROM (VALUES {SWEEP_VALUES}) t(v)),
c AS (SELECT g.threshold, CAST(sum(CASE WHEN score >= g.threshold THEN y ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN score >= g.threshold THEN 1 - y ELSE 0 END) AS DOUBLE) AS fp, CAST(sum(y) AS DOUBLE) AS P
  FROM scored CROSS JOIN g GROUP BY g.threshold),
m AS (SELECT threshold, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(P, 0), 0.0) AS r FROM c)
SELECT threshold, round(p, 4) AS precision, round(r, 4) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 4) AS f1 FROM m"""


@query("threshold_sweep", SWEEP_SQL, SC)
def q_threshold_sweep(spark, sf):
    """Precision / recall / F1 over thresholds 0.10..0.90 step 0.05, rounded to 4."""
    return G.threshold_sweep(scored(spark, sf), "y", "score")


CALIBRATED = (8.0, -1.0)      # the query's calibrator: its probabilities reach the recall target
CALIBRATED_SQL = SWEEP_SQL.strip().replace(
    "FROM scored CROSS JOIN", f"FROM (SELECT y, 1 / (1 + exp(-({CALIBRATED[0]} * score + {CALIBRATED[1]}))) AS score FROM scored) CROSS JOIN")


@query("recall_threshold", "WITH s AS (" + CALIBRATED_SQL + ")\nSELECT * FROM s WHERE recall >= 0.99 ORDER BY precision DESC, threshold ASC LIMIT 1", SC)
def q_recall_threshold(spark, sf):
    """Best precision subject to recall >= 0.99 over the sweep of calibrated probabilities."""
    df = scored(spark, sf).withColumn("score", S.apply_calibrator(F.col("score"), *CALIBRATED))
    return G.recall_threshold(G.threshold_sweep(df, "y", "score"), 0.99)


@query("benign_p99", """
SELECT CASE WHEN count(score) <= 10 THEN avg(score) ELSE quantile_cont(score, 0.99) END AS threshold,
 CASE WHEN count(score) <= 10 THEN 'mean' ELSE 'p99' END AS method, count(score) AS n_benign FROM scored WHERE y = 0""", SC)
def q_benign_p99(spark, sf):
    """Detector threshold = P99 of benign scores (mean when <= 10 benign)."""
    return G.benign_p99(scored(spark, sf), "y", "score")


@query("class_report", f"""
WITH c AS ({conf_sql(PRED, 'y', 'pred')}),
per AS (SELECT '0' AS class, coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0.0) AS p, coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0) AS r, tn + fp AS support FROM c
  UNION ALL SELECT '1', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), tp + fn FROM c),
pf AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0.0) AS f FROM per),
allr AS (SELECT class, p, r, f, support FROM pf
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM pf
  UNION ALL SELECT 'weighted avg', sum(p * support / (SELECT sum(support) FROM pf)), sum(r * support / (SELECT sum(support) FROM pf)),
   sum(f * support / (SELECT sum(support) FROM pf)), sum(support) FROM pf)
SELECT class, {sig('p')} AS precision, {sig('r')} AS recall, {sig('f')} AS f1, CAST(support AS BIGINT) AS support FROM allr""", SC)
def q_class_report(spark, sf):
    """Per-class precision / recall / F1 / support with macro and weighted averages."""
    return G.class_report(_pred(spark, sf), "y", "pred")


# cross-validation over hash folds (E5) for two scoring rules
CV_SRC = f"""(SELECT id, y, fold, model, s, CAST(s >= 0.5 AS INT) AS pred FROM (
  SELECT id, y, fold, model, CASE WHEN model = 'raw' THEN s0 ELSE s1 END AS s FROM (
  SELECT id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {hash32_sql('id')}, id, score, domain) - 1) % 5 AS INT) AS fold,
   score AS s0, score + 0.05 * CAST(domain = 'F' AS DOUBLE) AS s1 FROM scored) t
  CROSS JOIN (VALUES ('raw'), ('domain_adjusted')) m(model)))"""


def _cv_folds(spark, sf):
    df = E.kfold(scored(spark, sf), "id", "y", 5)
    raw = df.select("id", "y", "fold", F.lit("raw").alias("model"), F.col("score").alias("s"))
    adj = df.select("id", "y", "fold", F.lit("domain_adjusted").alias("model"),
                    (F.col("score") + F.lit(0.05) * (F.col("domain") == "F").cast("double")).alias("s"))
    return raw.unionByName(adj).withColumn("pred", (F.col("s") >= 0.5).cast("int"))


@query("cv_summary", f"""
WITH cv AS {CV_SRC},
m AS ({metrics_sql(conf_sql('cv', 'y', 'pred', ('model', 'fold')), 'model, fold, ')}),
a AS ({auc_sql('cv', 'y', 's', ('model', 'fold'))}),
fm AS (SELECT m.model, m.fold, accuracy, precision, recall, f1, roc_auc FROM m JOIN a ON m.model = a.model AND m.fold = a.fold),
l AS (UNPIVOT fm ON accuracy, precision, recall, f1, roc_auc INTO NAME metric VALUE value)
SELECT model, metric, {sig('avg(value)', 8)} AS mean, {sig('stddev_samp(value)', 8)} AS std, {sig('stddev_pop(value)', 8)} AS std_pop,
 {sig('min(value)', 8)} AS min, {sig('max(value)', 8)} AS max FROM l GROUP BY model, metric""", SC)
def q_cv_summary(spark, sf):
    """5 stratified hash folds x 2 scoring rules: per-fold metrics, then mean/std/min/max."""
    cv = _cv_folds(spark, sf)
    m = G.clf_metrics(cv, "y", "pred", ["model", "fold"])
    a = G.roc_auc(cv, "y", "s", ["model", "fold"])
    fm = m.join(a, ["model", "fold"])
    return G.cv_summary(fm, "model")


@query("metrics_by_domain", f"""
WITH m AS ({metrics_sql(conf_sql(PRED, 'y', 'pred', ('domain',)), 'domain, ')}),
a AS ({auc_sql('scored', 'y', 'score', ('domain',))}),
p AS ({ap_sql('scored', 'y', 'score', ('domain',))})
SELECT m.domain, tp, fp, tn, fn, {sig('accuracy')} AS accuracy, {sig('precision')} AS precision, {sig('recall')} AS recall,
 {sig('f1')} AS f1, roc_auc, average_precision FROM m JOIN a ON m.domain = a.domain JOIN p ON m.domain = p.domain""", SC)
def q_metrics_by_domain(spark, sf):
    """G1-G4 per domain (windows partitioned by domain)."""
    return domain_metrics(_pred(spark, sf), "score")


@query("gate_by_domain", EXPERTS_SQL + """,
l AS (SELECT domain, 'eMBB' AS expert, w1 AS w FROM ex UNION ALL SELECT domain, 'mMTC', w2 FROM ex
  UNION ALL SELECT domain, 'URLLC', w3 FROM ex UNION ALL SELECT domain, 'TCP_AE', w4 FROM ex UNION ALL SELECT domain, 'UDP_AE', w5 FROM ex)
SELECT domain, expert, """ + sig("avg(w)") + " AS mean_weight FROM l GROUP BY domain, expert", SC)
def q_gate_by_domain(spark, sf):
    """Mean gate weight by domain and expert."""
    return G.mean_weight_by(with_experts(spark, sf), "weights", "domain", S.EXPERT_NAMES)


def _expert_table(spark, sf):
    df = with_experts(spark, sf)
    return df.select("id", "y", "domain", "prob", "weights", "scores",
                     *[F.element_at("scores", i + 1).alias(n) for i, n in enumerate(SCORE_COLS)])


COMPARE_SQL = EXPERTS_SQL + ",\nlm AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS model, y, CAST(s{i + 1} >= 0.5 AS INT) AS pred FROM ex" for i, n in enumerate(S.EXPERT_NAMES)) + ")"


@query("best_model", COMPARE_SQL + f""",
m AS ({metrics_sql(conf_sql('lm', 'y', 'pred', ('model',)), 'model, ')}),
l AS (UNPIVOT (SELECT model, accuracy, precision, recall, f1 FROM m) ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)
SELECT metric, arg_min(model, (-value, model)) AS best, arg_min(model, (value, model)) AS worst,
 {sig('max(value)')} AS best_value, {sig('min(value)')} AS worst_value FROM l GROUP BY metric""", SC)
def q_best_model(spark, sf):
    """Compare the five experts at 0.5 and name the best / worst per metric."""
    df = _expert_table(spark, sf)
    parts = None
    for i, n in enumerate(S.EXPERT_NAMES):
        p = df.select(F.lit(n).alias("model"), "y", (F.col(SCORE_COLS[i]) >= 0.5).cast("int").alias("pred"))
        parts = p if parts is None else parts.unionByName(p)
    comp = G.clf_metrics(parts, "y", "pred", ["model"])
    return G.best_model(comp, "model")


@query("miss_rates", f"""
WITH c AS ({conf_sql(PRED, 'y', 'pred')})
SELECT {sig('coalesce(CAST(fn AS DOUBLE) / nullif(tp + fn, 0), 0.0)')} AS missed_attack_rate,
 {sig('coalesce(CAST(fp AS DOUBLE) / nullif(fp + tn, 0), 0.0)')} AS false_alarm_rate, fn AS n_missed, fp AS n_false_alarms FROM c""", SC)
def q_miss_rates(spark, sf):
    """Missed-attack and false-alarm rates."""
    return G.miss_rates(G.confusion(_pred(spark, sf), "y", "pred"))


@query("separation", f"""
SELECT {sig('avg(CASE WHEN y = 1 THEN score END)')} AS mean_attack, {sig('avg(CASE WHEN y = 0 THEN score END)')} AS mean_benign,
 {sig('avg(CASE WHEN y = 1 THEN score END) / nullif(avg(CASE WHEN y = 0 THEN score END), 0)')} AS ratio FROM scored""", SC)
def q_separation(spark, sf):
    """Mean score by class and their ratio."""
    return G.separation(scored(spark, sf), "y", "score")


# ---- F: scoring with given parameters ---------------------------------------
@query("apply_calibrator", f"SELECT id, {sig(_cal_sql(4.0, -2.0))} AS calibrated FROM scored", SC)
def q_apply_calibrator(spark, sf):
    """apply a fitted calibrator sigma(a*s + b)."""
    df = scored(spark, sf)
    return df.select("id", ssig(S.apply_calibrator(F.col("score"), 4.0, -2.0)).alias("calibrated"))


@query("expert_scores", EXPERTS_SQL + "\nSELECT id, " + ", ".join(
    f"{sig(f's{i + 1}')} AS {n}" for i, n in enumerate(SCORE_COLS)) + " FROM ex", SC)
def q_expert_scores(spark, sf):
    """five-expert score vector in fixed order from the given calibrators."""
    df = _expert_table(spark, sf)
    return df.select("id", *[ssig(F.col(n)).alias(n) for n in SCORE_COLS])


@query("weighted_combine", EXPERTS_SQL + f"\nSELECT id, {sig('prob')} AS prob FROM ex", SC)
def q_weighted_combine(spark, sf):
    """gate weights x expert scores -> sigma(4 (sum - 0.5))."""
    return with_experts(spark, sf).select("id", ssig(F.col("prob")).alias("prob"))


@query("dominant_expert", EXPERTS_SQL + """
SELECT id, CAST(CASE WHEN w1 >= greatest(w2, w3, w4, w5) THEN 0 WHEN w2 >= greatest(w3, w4, w5) THEN 1
 WHEN w3 >= greatest(w4, w5) THEN 2 WHEN w4 >= w5 THEN 3 ELSE 4 END AS INT) AS dominant FROM ex""", SC)
def q_dominant_expert(spark, sf):
    """F16: index of the largest gate weight, first on ties."""
    return with_experts(spark, sf).select("id", S.dominant_expert(F.col("weights")).alias("dominant"))


@query("ensemble_or", EXPERTS_SQL + """
SELECT id, greatest(CAST(s1 >= 0.5 AS INT), CAST(s3 >= 0.5 AS INT)) AS flag FROM ex""", SC)
def q_ensemble_or(spark, sf):
    """high-recall ensemble = max of two detectors' flags."""
    df = _expert_table(spark, sf)
    return df.select("id", S.ensemble_or((F.col("s_embb") >= 0.5).cast("int"),
                                         (F.col("s_urllc") >= 0.5).cast("int")).alias("flag"))


@query("ablation", EXPERTS_SQL + f""",
ab AS (SELECT y, 'trained' AS config, prob AS p FROM ex
  UNION ALL SELECT y, 'uniform', (0.0 + s1 + s2 + s3 + s4 + s5) / 5 FROM ex
  UNION ALL SELECT y, 'hard', CASE WHEN w1 >= greatest(w2, w3, w4, w5) THEN s1 WHEN w2 >= greatest(w3, w4, w5) THEN s2
   WHEN w3 >= greatest(w4, w5) THEN s3 WHEN w4 >= w5 THEN s4 ELSE s5 END FROM ex
  UNION ALL SELECT y, 'oracle', CASE WHEN y = 1 THEN greatest(s1, s2, s3, s4, s5) ELSE least(s1, s2, s3, s4, s5) END FROM ex),
abp AS (SELECT *, CAST(p >= 0.5 AS INT) AS pred FROM ab),
m AS ({metrics_sql(conf_sql('abp', 'y', 'pred', ('config',)), 'config, ')}),
a AS ({auc_sql('ab', 'y', 'p', ('config',))}),
p AS ({ap_sql('ab', 'y', 'p', ('config',))})
SELECT m.config, {sig('f1')} AS f1, {sig('recall')} AS recall, {sig('precision')} AS precision, {sig('roc_auc')} AS roc_auc,
 average_precision FROM m JOIN a ON m.config = a.config JOIN p ON m.config = p.config""", SC)
def q_ablation(spark, sf):
    """trained vs uniform vs hard (argmax) vs oracle single-expert combination."""
    return ablation_table(with_experts(spark, sf))


def ablation_table(df) -> DataFrame:
    """F1, recall, precision, AUC and AP of every combination of scores and weights (rows with y)."""
    ab = S.ablation_scores(F.col("weights"), F.col("scores"))
    ab["oracle"] = F.when(F.col("y") == 1, F.array_max("scores")).otherwise(F.array_min("scores"))
    pairs = F.array(*[F.struct(F.lit(name).alias("config"), e.alias("p")) for name, e in ab.items()])
    parts = df.select("y", F.inline(pairs)).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    m = G.clf_metrics(parts, "y", "pred", ["config"])
    a = G.roc_auc(parts, "y", "p", ["config"])
    ap = G.average_precision(parts, "y", "p", ["config"])
    out = m.join(a, "config").join(ap, "config")
    return out.select("config", *[ssig(F.col(x)).alias(x) for x in ("f1", "recall", "precision", "roc_auc")],
                      "average_precision")


def domain_metrics(df, score: str) -> DataFrame:
    """G1-G4 per domain of rows (domain, y, pred, score)."""
    m = _sig_metrics(G.clf_metrics(df, "y", "pred", ["domain"]), ["domain"])
    return m.join(G.roc_auc(df, "y", score, ["domain"]), "domain").join(
        G.average_precision(df, "y", score, ["domain"]), "domain")


@query("overfit_gap", f"""
WITH sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {hash32_sql('id')}, id, score, domain)
   <= floor((count(*) OVER (PARTITION BY y) * 80 + 50) / 100) THEN 'train' ELSE 'test' END AS split,
  CAST(score >= 0.5 AS INT) AS pred FROM scored),
m AS ({metrics_sql(conf_sql('sp', 'y', 'pred', ('split',)), 'split, ')})
SELECT {sig("max(CASE WHEN split = 'train' THEN f1 END)")} AS train_f1, {sig("max(CASE WHEN split = 'test' THEN f1 END)")} AS test_f1,
 {sig("max(CASE WHEN split = 'train' THEN f1 END) - max(CASE WHEN split = 'test' THEN f1 END)")} AS gap,
 max(CASE WHEN split = 'train' THEN f1 END) - max(CASE WHEN split = 'test' THEN f1 END) > 0.05 AS overfit FROM m""", SC)
def q_overfit_gap(spark, sf):
    """F1 on the stratified train vs test split; flag a gap > 0.05."""
    df = G.predictions(E.split_stratified(scored(spark, sf), "id", "y", 20), "score", 0.5)
    m = G.clf_metrics(df, "y", "pred", ["split"])
    g = m.agg(F.max(F.when(F.col("split") == "train", F.col("f1"))).alias("tr"),
              F.max(F.when(F.col("split") == "test", F.col("f1"))).alias("te"))
    return g.select(ssig(F.col("tr")).alias("train_f1"), ssig(F.col("te")).alias("test_f1"),
                    ssig(F.col("tr") - F.col("te")).alias("gap"), ((F.col("tr") - F.col("te")) > S.OVERFIT_GAP).alias("overfit"))


@query("batch_summary", EXPERTS_SQL + f"""
SELECT domain, CAST(sum(CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_attack_predicted,
 CAST(sum(CASE WHEN prob >= 0.5 THEN 0 ELSE 1 END) AS BIGINT) AS n_benign_predicted, {sig('avg(prob)')} AS mean_probability,
 {sig('avg(CASE WHEN prob >= 0.5 THEN 1.0 ELSE 0.0 END)')} AS attack_rate, count(*) AS n_rows FROM ex GROUP BY domain""", SC)
def q_batch_summary(spark, sf):
    """attack / benign counts, mean probability and attack rate per batch (domain)."""
    df = G.predictions(with_experts(spark, sf), "prob", 0.5)
    s = S.batch_summary(df, "pred", "prob", ["domain"])
    return s.select("domain", "n_attack_predicted", "n_benign_predicted", ssig(F.col("mean_probability")).alias("mean_probability"),
                    ssig(F.col("attack_rate")).alias("attack_rate"), "n_rows")
