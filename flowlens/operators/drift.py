"""Distribution drift (H1-H6).

PSI bins come from exact baseline quantiles (fitted, deduplicated edges);
both samples are bucketed by the same literal CASE expression and counted in
one aggregation.  The two-sample KS statistic is the maximum gap between the
two empirical CDFs, taken over distinct values with the distributed running
sum.  Only bin counts, edges and scalars reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.exprs import sig
from flowlens.functions.stats import c, clean_double, cumulative, exact_quantiles

# ---- fixed values ----------------------------------------------------------
PSI_BINS = 10
PSI_EPS = 1e-6
PSI_STABLE, PSI_ALERT = 0.1, 0.2
KS_P_THRESHOLD = 0.05
WINDOW_DAYS = 7
KS_SERIES_TERMS = 100
# ---------------------------------------------------------------------------


def weighted_quantiles(counts: DataFrame, col: str, weight: str, probs: Sequence[float]) -> list[float]:
    """Quantiles (linear interpolation) of values that each occur ``weight`` times; [] without values."""
    g = counts.where(c(col).isNotNull()).groupBy(clean_double(c(col)).alias("v")).agg(F.sum(c(weight)).alias("n")).where("v IS NOT NULL")
    run = cumulative(g, "v", ["n"])
    total = run.agg(F.max("n_cum")).first()[0]
    if not total:
        return []
    at = [(total - 1) * p for p in probs]
    ranks = sorted({k for x in at for k in (math.floor(x), math.ceil(x))})
    wanted = F.broadcast(counts.sparkSession.createDataFrame([(k,) for k in ranks], "rank long"))     # two rows per quantile
    hit = run.join(wanted, (F.col("rank") < F.col("n_cum")) & (F.col("rank") >= F.col("n_cum") - F.col("n")))
    value = {r["rank"]: r["v"] for r in hit.select("rank", "v").collect()}
    return [value[math.floor(x)] + (value[math.ceil(x)] - value[math.floor(x)]) * (x - math.floor(x)) for x in at]


def psi_edges(baseline: DataFrame, col: str, bins: int = PSI_BINS, by: Sequence[str] = (), weight: str | None = None) -> dict:
    """Deduplicated baseline percentile edges (0, 10, ..., 100 %) per group; ``weight``: occurrences of each row."""
    probs = [i / bins for i in range(bins + 1)]
    if weight:
        return {(): sorted(set(weighted_quantiles(baseline, col, weight, probs)))}
    q = exact_quantiles(baseline, [col], probs, by=by)
    return {k[:-1]: sorted(set(v)) for k, v in q.items() if v and v[0] is not None}


def bucket_expr(x: Column, edges: Sequence[float], closed_range: bool = False) -> Column:
    """Bin index like numpy.histogram: [e_i, e_i+1), last bin closed.  Values
    outside [e_0, e_k] go to the outer bins (open) or to NULL (closed_range)."""
    k = len(edges) - 1
    e = F.lit(k - 1)
    for i in range(k - 1, 0, -1):
        e = F.when(x < F.lit(edges[i]), F.lit(i - 1)).otherwise(e)
    if closed_range:
        e = F.when((x >= F.lit(edges[0])) & (x <= F.lit(edges[-1])), e)
    return F.when(x.isNotNull(), e)


def _times(weight: str | None) -> Column:
    return c(weight).cast("long") if weight else F.lit(1).cast("long")


def psi_table(baseline: DataFrame, current: DataFrame, col: str, edges: Sequence[float],
              closed_range: bool = False, weight: str | None = None) -> DataFrame:
    """(bin, base_n, curr_n, p, q, term) with the 1e-6 guard; one aggregation."""
    both = (baseline.select(clean_double(c(col)).alias("v"), F.lit(0).alias("side"), _times(weight).alias("w"))
            .unionByName(current.select(clean_double(c(col)).alias("v"), F.lit(1).alias("side"), _times(weight).alias("w"))))
    b = both.select(bucket_expr(F.col("v"), edges, closed_range).alias("bin"), "side", "w").where("bin IS NOT NULL")
    spark = baseline.sparkSession
    spine = spark.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))
    g = b.groupBy("bin").agg(F.sum(F.when(F.col("side") == 0, F.col("w")).otherwise(0)).alias("base_n"),
                             F.sum(F.when(F.col("side") == 1, F.col("w")).otherwise(0)).alias("curr_n"))
    g = spine.join(g, "bin", "left").na.fill(0, ["base_n", "curr_n"])
    tot = g.agg(F.sum("base_n").alias("B"), F.sum("curr_n").alias("Q"))  # one row
    g = g.crossJoin(tot)
    p = F.try_divide(F.col("base_n").cast("double"), F.col("B"))
    q = F.try_divide(F.col("curr_n").cast("double"), F.col("Q"))
    pg = F.when(p == 0, F.lit(PSI_EPS)).otherwise(p)
    qg = F.when(q == 0, F.lit(PSI_EPS)).otherwise(q)
    term = F.when((p == 0) & (q == 0), F.lit(0.0)).otherwise((pg - qg) * F.log(pg / qg))
    return g.select("bin", "base_n", "curr_n", p.alias("p"), q.alias("q"), term.alias("term"))


def psi(baseline: DataFrame, current: DataFrame, col: str, bins: int = PSI_BINS,
        closed_range: bool = False, weight: str | None = None) -> DataFrame:
    """Population stability index; 0 when either side is empty or < 2 distinct edges."""
    edges = psi_edges(baseline, col, bins, weight=weight).get((), [])
    spark = baseline.sparkSession
    if len(edges) < 2:
        return spark.createDataFrame([(0.0, len(edges))], "psi double, n_edges int")
    t = psi_table(baseline, current, col, edges, closed_range, weight)
    s = t.agg(F.sum("term").alias("psi"), F.sum("base_n").alias("B"), F.sum("curr_n").alias("Q"))
    return s.select(F.when((F.col("B") > 0) & (F.col("Q") > 0), F.col("psi")).otherwise(F.lit(0.0)).alias("psi"),
                    F.lit(len(edges)).alias("n_edges"))


def drift_band(psi_col: Column) -> Column:
    """< 0.1 stable, < 0.2 monitor, else alert (H4)."""
    return F.when(psi_col < PSI_STABLE, "stable").when(psi_col < PSI_ALERT, "monitor").otherwise("alert")


def ks_statistic(a: DataFrame, b: DataFrame, col: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Two-sample KS statistic D = max |F_a - F_b| (per group), with sample sizes."""
    none = F.lit(0).cast("long")
    both = (a.select(*[c(x) for x in by], clean_double(c(col)).alias("v"), _times(weight).alias("na"), none.alias("nb"))
            .unionByName(b.select(*[c(x) for x in by], clean_double(c(col)).alias("v"), none.alias("na"),
                                  _times(weight).alias("nb"))).where("v IS NOT NULL"))
    cnt = both.groupBy(*by, "v").agg(F.sum("na").alias("ca"), F.sum("nb").alias("cb"))
    cum = cumulative(cnt, "v", ["ca", "cb"], key_cols=list(by))
    tot = cnt.groupBy(*by).agg(F.sum("ca").alias("n_a"), F.sum("cb").alias("n_b"))
    j = cum.join(F.broadcast(tot), list(by)) if by else cum.crossJoin(tot)  # tot: one row per group
    gap = F.abs(F.try_divide(F.col("ca_cum").cast("double"), F.col("n_a"))
                - F.try_divide(F.col("cb_cum").cast("double"), F.col("n_b")))
    return j.groupBy(*by, "n_a", "n_b").agg(F.max(gap).alias("ks_statistic"))


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = KS_SERIES_TERMS) -> Column:
    """Asymptotic p-value: Q_KS((sqrt(en) + 0.12 + 0.11 / sqrt(en)) * D), en = n m / (n + m)."""
    en = F.sqrt(F.try_divide(n * m, n + m))
    lam = (en + F.lit(0.12) + F.try_divide(F.lit(0.11), en)) * d  # NULL for an empty side
    def term(acc, k):
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return acc + F.lit(2.0) * sign * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam)

    s = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), term)
    return F.when(lam < 1e-3, F.lit(1.0)).otherwise(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)))


def drift_report(baseline: DataFrame, recent: DataFrame, rate_col: str = "attack_rate",
                 prob_col: str = "mean_probability", window_days: int = WINDOW_DAYS,
                 psi_threshold: float = PSI_ALERT, ks_p_threshold: float = KS_P_THRESHOLD) -> DataFrame:
    """One-row drift report: PSI of the attack rate and KS of the mean probability
    between a real baseline window and the recent window; 'no_data' when empty."""
    p = psi(baseline, recent, rate_col).select("psi")
    ks = ks_statistic(baseline, recent, prob_col)
    base = baseline.agg(F.avg(c(rate_col)).alias("baseline_attack_rate"))
    rec = recent.agg(F.count(F.lit(1)).alias("n_requests"), F.avg(c(rate_col)).alias("recent_mean_attack_rate"))
    return _report(p, ks, base, rec, window_days, psi_threshold, ks_p_threshold)


def _report(p: DataFrame, ks: DataFrame, base: DataFrame, rec: DataFrame, window_days: int, psi_threshold: float,
            ks_p_threshold: float) -> DataFrame:
    spark = rec.sparkSession
    ks = ks.select("ks_statistic", ks_pvalue(F.col("ks_statistic"), F.col("n_a").cast("double"), F.col("n_b").cast("double")).alias("ks_p"))
    one = rec.crossJoin(base).crossJoin(p).join(ks, how="left")  # single rows
    one = one.crossJoin(spark.range(1).select(F.lit(window_days).alias("window_days")))
    a1 = F.when(F.col("psi") >= psi_threshold, F.format_string(
        f"attack rate moved: PSI %.3f, limit {psi_threshold}", F.round("psi", 3)))
    a2 = F.when(F.col("ks_p") < ks_p_threshold, F.format_string(
        f"scores moved: KS p-value %.4f, limit {ks_p_threshold}", F.round("ks_p", 4)))
    drifted = (F.col("psi") >= psi_threshold) | (F.coalesce(F.col("ks_p"), F.lit(1.0)) < ks_p_threshold)
    return one.select(
        F.when(F.col("n_requests") == 0, "no_data").when(drifted, "drift_detected").otherwise("ok").alias("status"),
        "window_days", "n_requests", sig(F.col("baseline_attack_rate")).alias("baseline_attack_rate"),
        sig(F.col("recent_mean_attack_rate")).alias("recent_mean_attack_rate"),
        F.round("psi", 4).alias("psi_attack_rate"), F.round("ks_statistic", 4).alias("ks_statistic"),
        F.round("ks_p", 4).alias("ks_p_value"),
        F.filter(F.array(a1, a2), lambda x: x.isNotNull()).alias("alerts"))


# --- state per day (I3) ----------------------------------------------------------------

STATE_SCHEMA = "metric string, value double, n long, day date, batch_id long"


def day_state(log: DataFrame, ts: str = "ts", rate_col: str = "attack_rate", prob_col: str = "mean_probability") -> DataFrame:
    """(day, metric, value, n): how often each value of the two logged metrics occurs on a day.

    Counts by value are all that the report needs (quantiles, bins, empirical distributions,
    means), and states of several batches or days merge by adding them up.
    """
    pair = F.explode(F.array(F.struct(F.lit("rate").alias("metric"), c(rate_col).cast("double").alias("value")),
                             F.struct(F.lit("prob").alias("metric"), c(prob_col).cast("double").alias("value")))).alias("s")
    return (log.select(c(ts).cast("date").alias("day"), pair).groupBy("day", "s.metric", "s.value")
            .agg(F.count(F.lit(1)).alias("n")).select("metric", "value", "n", "day"))


def state_report(baseline: DataFrame, recent: DataFrame, window_days: int = WINDOW_DAYS, psi_threshold: float = PSI_ALERT,
                 ks_p_threshold: float = KS_P_THRESHOLD) -> DataFrame:
    """:func:`drift_report` from day states (metric, value, n) of the two windows."""
    def part(state, metric):
        return state.where(F.col("metric") == metric).select("value", "n")

    def mean(state, out):
        v = clean_double(F.col("value"))
        return F.try_divide(F.sum(v * F.col("n")), F.sum(F.when(v.isNotNull(), F.col("n")))).alias(out)

    rates, recent_rates = part(baseline, "rate"), part(recent, "rate")
    p = psi(rates, recent_rates, "value", weight="n").select("psi")
    ks = ks_statistic(part(baseline, "prob"), part(recent, "prob"), "value", weight="n")
    rec = recent_rates.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_requests"), mean(recent_rates, "recent_mean_attack_rate"))
    return _report(p, ks, rates.agg(mean(rates, "baseline_attack_rate")), rec, window_days, psi_threshold, ks_p_threshold)


def feature_drift(baseline: DataFrame, current: DataFrame, features: Sequence[str],
                  bins: int = PSI_BINS) -> DataFrame:
    """PSI, KS statistic and band per feature over the stacked features (H5): one quantile fit, one
    grouped count and one grouped running sum for all features."""
    probs = [i / bins for i in range(bins + 1)]
    q = exact_quantiles(baseline, list(features), probs)
    edges = [(f, sorted(set(q[(f,)]))) for f in features if q.get((f,)) and q[(f,)][0] is not None]
    fitted = baseline.sparkSession.createDataFrame([(f, e) for f, e in edges if len(e) > 1], "feature string, edges array<double>")
    stack = lambda d, side: d.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), clean_double(c(f)).alias("v")) for f in features])).alias("s")
    ).select("s.feature", F.col("s.v").alias(side))
    both = (stack(baseline, "v").withColumn("side", F.lit(0)).unionByName(stack(current, "v").withColumn("side", F.lit(1)))
            .where("v IS NOT NULL").join(F.broadcast(fitted), "feature"))                       # one row per feature
    inner = F.filter("edges", lambda e, i: (i > 0) & (i < F.size("edges") - 1) & (e <= F.col("v")))
    g = both.groupBy("feature", F.size(inner).alias("bin")).agg(
        F.sum((F.col("side") == 0).cast("long")).alias("base_n"), F.sum((F.col("side") == 1).cast("long")).alias("curr_n"))
    totals = Window.partitionBy("feature")                                                      # ``bins`` rows each
    p = F.try_divide(F.col("base_n").cast("double"), F.sum("base_n").over(totals))
    r = F.try_divide(F.col("curr_n").cast("double"), F.sum("curr_n").over(totals))
    g = g.select("feature", "base_n", "curr_n", F.when(p == 0, PSI_EPS).otherwise(p).alias("p"), F.when(r == 0, PSI_EPS).otherwise(r).alias("q"))
    found = g.groupBy("feature").agg(F.when((F.sum("base_n") > 0) & (F.sum("curr_n") > 0),
                                            F.sum((F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q")))).alias("psi"))
    ks = ks_statistic(stack(baseline, "x"), stack(current, "x"), "x", by=["feature"]).select("feature", "ks_statistic")
    both = ks.join(F.broadcast(found), "feature", "left").withColumn("psi", F.coalesce("psi", F.lit(0.0)))
    return both.select("feature", sig(F.col("psi")).alias("psi"), sig(F.col("ks_statistic")).alias("ks_statistic"),
                       drift_band(F.col("psi")).alias("band"))
