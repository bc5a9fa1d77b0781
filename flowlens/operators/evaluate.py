"""Evaluation metrics.

Ranking metrics (ROC-AUC, average precision, ROC / PR curves, best
threshold) are computed from per-(group, distinct score) class counts: the
data is first aggregated by score (map-side combined), then running sums are
taken with :func:`~flowlens.functions.stats.cumulative`, so no global window
ever pulls a whole score column into one task.  Ties are handled exactly
(ROC ties count half; PR steps are taken per distinct threshold).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.exprs import sig
from flowlens.functions.stats import c, cumulative

F1_EPS = 1e-8  # fixed value: denominator guard of the F1-optimal threshold
SWEEP = [round(0.10 + 0.05 * i, 2) for i in range(17)]  # 0.10 ... 0.90


def _div(a: Column, b: Column) -> Column:
    """a / b, 0 when the denominator is 0 (sklearn zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def predictions(df: DataFrame, score: str, threshold: float = 0.5, out: str = "pred") -> DataFrame:
    return df.withColumn(out, (c(score) >= F.lit(threshold)).cast("int"))


# G1
def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = c(label), c(pred)
    return df.groupBy(*[c(b) for b in by]).agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"))


def metrics_from_confusion(cm: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    prec = _div(tp, tp + fp)
    rec = _div(tp, tp + fn)
    return cm.select(*keep, "tp", "fp", "tn", "fn",
                     _div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                     prec.alias("precision"), rec.alias("recall"),
                     _div(2 * prec * rec, prec + rec).alias("f1"))


# G2
def clf_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return metrics_from_confusion(confusion(df, label, pred, by), by)


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, neg) per distinct score; the partial aggregation is map-side."""
    return df.groupBy(*[c(b).alias(b) for b in by], c(score).alias("score")).agg(
        F.sum(c(label).cast("long")).alias("pos"),
        F.sum((1 - c(label)).cast("long")).alias("neg"))


def _ranked(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Distinct scores, descending, with tp/fp running sums and class totals."""
    cnt = score_counts(df, label, score, by)
    cum = cumulative(cnt, "score", ["pos", "neg"], key_cols=list(by), descending=True)
    tot = cnt.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cum = cum.withColumnRenamed("pos_cum", "tp").withColumnRenamed("neg_cum", "fp")
    return cum.join(F.broadcast(tot), list(by)) if by else cum.crossJoin(tot)  # tot: one row per group


# G3
def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC with ties counted half; NULL when a class is absent."""
    r = _ranked(df, label, score, by)
    # integer-valued numerator (x2) keeps the sum exact in any order
    term = F.col("pos").cast("double") * (2 * (F.col("N") - F.col("fp")) + F.col("neg"))  # BIGINT would overflow
    g = r.groupBy(*by, "P", "N").agg(F.sum(term).alias("num2"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0),
                 F.col("num2") / (F.lit(2.0) * F.col("P").cast("double") * F.col("N").cast("double")))
    return g.select(*by, auc.alias("roc_auc"))


# G4
def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    r = _ranked(df, label, score, by)
    term = (F.col("pos") / F.col("P")) * (F.col("tp") / (F.col("tp") + F.col("fp")))
    g = r.where("P > 0").groupBy(*by).agg(F.sum(term).alias("ap"))
    return g.select(*by, sig(F.col("ap")).alias("average_precision"))


# G5
def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    r = _ranked(df, label, score, by)
    return r.select(*by, F.col("score").alias("threshold"),
                    _div(F.col("fp"), F.col("N")).alias("fpr"), _div(F.col("tp"), F.col("P")).alias("tpr"))


# G6
def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    r = _ranked(df, label, score, by)
    return r.select(*by, F.col("score").alias("threshold"),
                    _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    _div(F.col("tp"), F.col("P")).alias("recall"))


# G7
def best_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """argmax over distinct thresholds of 2PR / (P + R + 1e-8); ties -> lowest threshold."""
    pr = pr_curve(df, label, score)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(F1_EPS))
    best = pr.select("threshold", "precision", "recall", f1.alias("f1")).agg(
        F.min_by(F.struct("threshold", "precision", "recall", "f1"),
                 F.struct(-F.col("f1"), F.col("threshold"))).alias("b"))
    return best.select("b.threshold", sig(F.col("b.precision")).alias("precision"),
                       sig(F.col("b.recall")).alias("recall"), sig(F.col("b.f1")).alias("f1"))


# G8
def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float] = SWEEP) -> DataFrame:
    """P, R, F1 (rounded to 4) per threshold of a fixed grid.  Each row is counted once,
    under the number of thresholds it reaches; the grid meets those few counts only."""
    spark = df.sparkSession
    steps = sorted({float(t) for t in thresholds})
    reached = sum((F.coalesce((c(score) >= F.lit(t)).cast("int"), F.lit(0)) for t in steps), F.lit(0))
    cnt = df.groupBy(reached.alias("reached")).agg(
        F.sum(c(label).cast("long")).alias("pos"), F.sum((1 - c(label)).cast("long")).alias("neg"))
    grid = spark.createDataFrame([(t, i + 1) for i, t in enumerate(steps)], "threshold double, rank int")
    tot = cnt.agg(F.sum("pos").alias("P"))
    hit = cnt.crossJoin(F.broadcast(grid)).where(F.col("reached") >= F.col("rank"))   # at most 18 x 17 rows
    g = grid.join(hit.groupBy("threshold").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp")),
                  "threshold", "left").crossJoin(tot)
    tp, fp = F.coalesce("tp", F.lit(0)), F.coalesce("fp", F.lit(0))
    prec = _div(tp, tp + fp)
    rec = _div(tp, F.col("P"))
    f1 = _div(2 * prec * rec, prec + rec)
    return g.select("threshold", F.round(prec, 4).alias("precision"), F.round(rec, 4).alias("recall"),
                    F.round(f1, 4).alias("f1"))


# G9
def recall_threshold(sweep: DataFrame, min_recall: float = 0.99) -> DataFrame:
    ok = sweep.where(F.col("recall") >= min_recall)
    return ok.agg(F.min_by(F.struct("threshold", "precision", "recall", "f1"),
                           F.struct(-F.col("precision"), F.col("threshold"))).alias("b")).select("b.*").where(
        F.col("threshold").isNotNull())


# G10
def benign_p99(df: DataFrame, label: str, score: str, q: float = 0.99, min_benign: int = 10) -> DataFrame:
    from flowlens.functions.stats import quantiles_of
    benign = df.where(c(label) == 0)
    st = benign.agg(F.count(c(score)).alias("n"), F.avg(c(score)).alias("m")).first()
    if st["n"] <= min_benign:
        val, how = st["m"], "mean"
    else:
        val, how = quantiles_of(benign, [score], [q])[score][0], f"p{int(q * 100)}"
    return df.sparkSession.createDataFrame([(val, how, st["n"])], "threshold double, method string, n_benign long")


# G11
def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    cm = confusion(df, label, pred)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    rows = []
    for cls, (a, b, d) in {"0": (tn, fn, fp), "1": (tp, fp, fn)}.items():
        p = _div(a, a + b)
        r = _div(a, a + d)
        rows.append(cm.select(F.lit(cls).alias("class"), p.alias("precision"), r.alias("recall"),
                              _div(2 * p * r, p + r).alias("f1"), (a + d).alias("support")))
    per = rows[0].unionByName(rows[1])
    tot = per.agg(F.sum("support").alias("n"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wsum = per.crossJoin(tot).agg(
        F.lit("weighted avg").alias("class"),
        F.sum(F.col("precision") * F.col("support") / F.col("n")).alias("precision"),
        F.sum(F.col("recall") * F.col("support") / F.col("n")).alias("recall"),
        F.sum(F.col("f1") * F.col("support") / F.col("n")).alias("f1"), F.sum("support").alias("support"))
    out = per.unionByName(macro).unionByName(wsum)
    return out.select("class", *[sig(F.col(x)).alias(x) for x in ("precision", "recall", "f1")], "support")


# G12
def cv_summary(fold_metrics: DataFrame, model: str = "model",
               metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1", "roc_auc")) -> DataFrame:
    """Per model and metric: mean, sample std, population std, min, max over folds."""
    long = fold_metrics.unpivot([model, "fold"], list(metrics), "metric", "value")
    g = long.groupBy(model, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.stddev_pop("value").alias("std_pop"), F.min("value").alias("min"), F.max("value").alias("max"))
    return g.select(model, "metric", *[sig(F.col(x), 8).alias(x) for x in ("mean", "std", "std_pop", "min", "max")])


# G14
def mean_weight_by(df: DataFrame, weights: str, by: str, names: Sequence[str]) -> DataFrame:
    # averages first: a filter that Spark infers from exploding computed weights would repeat
    # their whole expression once per layer of the gate
    g = df.groupBy(by).agg(*[F.avg(F.get(c(weights), F.lit(i))).alias(f"_{i}") for i in range(len(names))])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("expert"), F.col(f"_{i}").alias("w")) for i, n in enumerate(names)]))
    long = g.select(c(by).alias(by), pairs.alias("_p")).where("_p.w IS NOT NULL")
    return long.select(by, "_p.expert", sig(F.col("_p.w")).alias("mean_weight"))


# G15
def best_model(comparison: DataFrame, model: str = "model",
               metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1")) -> DataFrame:
    long = comparison.unpivot([model], list(metrics), "metric", "value")
    return long.groupBy("metric").agg(
        F.min_by(model, F.struct(-F.col("value"), F.col(model))).alias("best"),
        F.min_by(model, F.struct(F.col("value"), F.col(model))).alias("worst"),
        sig(F.max("value")).alias("best_value"), sig(F.min("value")).alias("worst_value"))


# G16
def miss_rates(cm: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return cm.select(sig(_div(fn, tp + fn)).alias("missed_attack_rate"),
                     sig(_div(fp, fp + tn)).alias("false_alarm_rate"), fn.alias("n_missed"), fp.alias("n_false_alarms"))


# G17
def separation(df: DataFrame, label: str, score: str) -> DataFrame:
    g = df.agg(F.avg(F.when(c(label) == 1, c(score))).alias("mean_attack"),
               F.avg(F.when(c(label) == 0, c(score))).alias("mean_benign"))
    return g.select(sig(F.col("mean_attack")).alias("mean_attack"), sig(F.col("mean_benign")).alias("mean_benign"),
                    sig(F.try_divide(F.col("mean_attack"), F.col("mean_benign"))).alias("ratio"))
