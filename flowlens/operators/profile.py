"""Profiling aggregates.

Per-column statistics are computed on the long (feature, value) form so
that one shuffle of tiny partial aggregates (one row per feature per task)
covers every column; exact quantiles come from the distributed
:func:`~flowlens.functions.stats.exact_quantiles`.  Results are returned as
DataFrames; only fitted scalars (quantiles, min/max) pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.exprs import sig
from flowlens.functions.stats import (agg_row, c, clean_double, held, long_format, numeric_columns, partition_sums,
                                      pearson, quantiles_of, sample_skew_from_pop, string_columns,
                                      value_counts)
from flowlens.operators.clean import fit_corr_matrix

# ---- fixed values ----------------------------------------------------------
PROTOCOL_REPORT_NAMES = {6: "TCP", 17: "UDP", 0: "Other/Unknown"}
WELL_KNOWN_PORTS = {80: "HTTP", 443: "HTTPS", 22: "SSH", 53: "DNS", 21: "FTP", 25: "SMTP",
                    3389: "RDP", 8080: "HTTP-Alt"}
SKEW_HIGH, SKEW_MODERATE = 1.0, 0.5
CARD_OHE, CARD_TARGET = 10, 50
TRANSFORM_CATEGORICAL_COLS = ["sTos", "dTos"]
# ---------------------------------------------------------------------------


def _long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    lf = long_format(df, cols, ids=ids, name="feature", value="value")
    return lf.withColumn("value", clean_double(F.col("value")))


def _small(spark, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# B1
def dataset_summary(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        nnum = len(numeric_columns(df))
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
            F.lit(nnum).alias("n_numeric"), F.lit(len(df.columns) - nnum).alias("n_categorical"))
        out = part if out is None else out.unionByName(part)
    return out


# B2
def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    with held(df, *[c(x) for x in cols]) as d:        # read by several passes
        return _describe_numeric(d, cols).checkpoint()                # a row per feature


def _describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    q = quantiles_of(df, cols, [0.25, 0.5, 0.75])
    qdf = _small(df.sparkSession, [(k, *v) for k, v in q.items()],
                 "feature string, p25 double, p50 double, p75 double")
    mom = _long(df, cols).groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    return mom.join(qdf, "feature", "left").select(
        "feature", "count", sig(F.col("mean")).alias("mean"), sig(F.col("std")).alias("std"),
        "min", sig(F.col("p25")).alias("p25"), sig(F.col("p50")).alias("p50"),
        sig(F.col("p75")).alias("p75"), "max")


# B3
def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else string_columns(df)
    vc = value_counts(df, cols, name="feature")
    return vc.groupBy("feature").agg(
        F.sum("count").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top"),
        F.max("count").alias("freq"))


# B4
def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else df.columns
    nums = set(numeric_columns(df))
    exprs = [F.sum((clean_double(c(x)) if x in nums else c(x)).isNull().cast("long")).alias(x)
             for x in cols]
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *exprs)
    longdf = wide.unpivot(["_n"], cols, "feature", "n_missing")
    per = longdf.where("n_missing > 0").select(
        "feature", "n_missing", F.round(F.col("n_missing") * 100.0 / F.col("_n"), 4).alias("pct"))
    total = longdf.groupBy("_n").agg(F.sum("n_missing").alias("n_missing")).select(
        F.lit("__total__").alias("feature"), "n_missing",
        F.round(F.col("n_missing") * 100.0 / (F.col("_n") * F.lit(len(cols))), 4).alias("pct"))
    return per.unionByName(total)


# B5
def sentinel_report(df: DataFrame, cols: Sequence[str] | None = None, sentinel: str = "?") -> DataFrame:
    cols = list(cols) if cols is not None else string_columns(df)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum((c(x) == sentinel).cast("long")).alias(x) for x in cols])
    return wide.unpivot(["_n"], cols, "feature", "n_sentinel").select(
        "feature", F.coalesce("n_sentinel", F.lit(0)).alias("n_sentinel"),
        F.round(F.coalesce("n_sentinel", F.lit(0)) * 100.0 / F.col("_n"), 4).alias("pct"))


# B6
def zero_inf_report(df: DataFrame, cols: Sequence[str] | None = None, zero_share: float = 0.5) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    lf = long_format(df, cols, name="feature", value="value")
    g = lf.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.abs("value") == float("inf")).cast("long")).alias("n_inf"),
        F.sum((F.col("value") == 0).cast("long")).alias("n_zero"))
    return g.select("feature", F.coalesce("n_inf", F.lit(0)).alias("n_inf"),
                    F.coalesce("n_zero", F.lit(0)).alias("n_zero"),
                    F.round(F.coalesce("n_zero", F.lit(0)) * 100.0 / F.col("n"), 4).alias("pct_zero"),
                    (F.coalesce("n_zero", F.lit(0)) > F.col("n") * zero_share).alias("zero_inflated"))


# B7
def duplicate_groups(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Every duplicated row value with its number of copies (partial aggregation
    collapses hot groups map-side; no group is ever materialised in one task)."""
    cols = list(cols) if cols is not None else df.columns
    return (df.groupBy(*[c(x) for x in cols]).agg(F.count(F.lit(1)).alias("n_copies"))
            .where("n_copies > 1"))


def duplicate_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    g = duplicate_groups(df, cols)
    tot = df.agg(F.count(F.lit(1)).alias("n_rows"))
    d = g.agg(F.coalesce(F.sum(F.col("n_copies") - 1), F.lit(0)).alias("n_duplicates"),
              F.count(F.lit(1)).alias("n_groups"))
    return tot.crossJoin(d).select(  # one-row x one-row
        "n_rows", "n_duplicates", "n_groups",
        F.round(F.col("n_duplicates") * 100.0 / F.col("n_rows"), 4).alias("pct"))


# B8
def label_distribution(df: DataFrame, label: str = "Label", dropna: bool = False) -> DataFrame:
    d = df.where(c(label).isNotNull()) if dropna else df
    g = d.groupBy(c(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # over the handful of label rows only
    return g.select("label", "n", F.round(F.col("n") * 100.0 / F.sum("n").over(w), 4).alias("pct"))


# B9
def slice_distribution(df: DataFrame, dataset: str, slice_col: str) -> DataFrame:
    return df.groupBy(c(dataset).alias("dataset"), c(slice_col).alias("slice")).agg(
        F.count(F.lit(1)).alias("n"))


# B10
def value_counts_topk(df: DataFrame, cols: Sequence[str] | None = None, k: int = 15) -> DataFrame:
    cols = list(cols) if cols is not None else string_columns(df)
    vc = value_counts(df, cols, name="feature")
    w = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc("value"))
    # rank filter becomes a per-partition group limit before the window shuffle
    return vc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# B11
def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty bins included."""
    x = clean_double(c(col))
    st = agg_row(df, {"lo": F.min(x), "hi": F.max(x), "n": F.count(x)})
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        lo, hi = 0.0, 1.0
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = [c(by).alias("group")] if by else []
    counted = df.where(x.isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        groups = df.select(c(by).alias("group")).distinct()
        spine = groups.crossJoin(spine)  # groups x bins: both bounded (classes x n_bins)
        tot = counted.groupBy("group").agg(F.sum("count").alias("_tot"))
        out = spine.join(counted, ["group", "bin"], "left").join(tot, "group", "left")
    else:
        out = spine.join(counted, "bin", "left").withColumn("_tot", F.lit(st["n"]))
    out = out.withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
    out = out.withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width)).withColumn(
        "bin_hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width))
    if density:
        out = out.withColumn("density", F.col("count") / (F.col("_tot") * F.lit(width)))
    return out.drop("_tot")


# B12
def feature_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    with held(df, *[c(x) for x in cols]) as d:        # read by several passes
        return _feature_summary(d, cols).checkpoint()                # a row per feature


def _feature_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    q = quantiles_of(df, cols, [0.25, 0.5, 0.75])
    fences = {k: (v[0] - 1.5 * (v[2] - v[0]), v[2] + 1.5 * (v[2] - v[0])) if v[0] is not None else (None, None)
              for k, v in q.items()}
    qdf = _small(df.sparkSession, [(k, v[1], fences[k][0], fences[k][1]) for k, v in q.items()],
                 "feature string, median double, lo_fence double, hi_fence double")
    lf = _long(df, cols).where(F.col("value").isNotNull()).join(F.broadcast(qdf), "feature")
    g = lf.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.first("median").alias("median"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.skewness("value").alias("g1"), F.count("value").alias("n"),
        F.sum(((F.col("value") < F.col("lo_fence")) | (F.col("value") > F.col("hi_fence"))).cast("long"))
        .alias("n_outliers"))
    return g.select("feature", sig(F.col("mean")).alias("mean"), "median", sig(F.col("std")).alias("std"),
                    "min", "max", sig(sample_skew_from_pop(F.col("g1"), F.col("n").cast("double"))).alias("skew"),
                    "n_outliers")


# B13
def outlier_report(df: DataFrame, cols: Sequence[str] | None = None, z: float = 3.0) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    with held(df, *[c(x) for x in cols]) as d:        # read by several passes
        return _outlier_report(d, cols, z).checkpoint()                # a row per feature


def _outlier_report(df: DataFrame, cols: Sequence[str], z: float) -> DataFrame:
    q = quantiles_of(df, cols, [0.25, 0.75])
    mom = agg_row(df, {**{(x, "m"): F.avg(clean_double(c(x))) for x in cols},
                       **{(x, "s"): F.stddev_pop(clean_double(c(x))) for x in cols}})
    rows = []
    for x in cols:
        q1, q3 = q[x]
        if q1 is None:
            continue
        iqr = q3 - q1
        rows.append((x, q1, q3, iqr, q1 - 1.5 * iqr, q3 + 1.5 * iqr, mom[(x, "m")], mom[(x, "s")]))
    params = _small(df.sparkSession, rows,
                    "feature string, q1 double, q3 double, iqr double, lower double, upper double, "
                    "mu double, sd double")
    lf = _long(df, cols).where(F.col("value").isNotNull()).join(F.broadcast(params), "feature")
    zs = F.when(F.col("sd") > 0, F.abs((F.col("value") - F.col("mu")) / F.col("sd")))
    g = lf.groupBy("feature", "q1", "q3", "iqr", "lower", "upper").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).cast("long")).alias("n_iqr"),
        F.sum(F.coalesce((zs > z).cast("long"), F.lit(0))).alias("n_z"))
    return g.select("feature", "q1", "q3", "iqr", "lower", "upper", "n_iqr",
                    F.round(F.col("n_iqr") * 100.0 / F.col("n"), 4).alias("pct_iqr"), "n_z",
                    F.round(F.col("n_z") * 100.0 / F.col("n"), 4).alias("pct_z"))


# B14
def skew_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    g = _long(df, cols).groupBy("feature").agg(
        F.skewness("value").alias("s"), F.kurtosis("value").alias("k"),
        F.stddev_samp("value").alias("sd"), F.count("value").alias("n"))
    g = g.where((F.col("n") > 1) & (F.col("sd") > 0))
    a = F.abs(F.col("s"))
    cat = F.when(a > SKEW_HIGH, "Highly Skewed").when(a > SKEW_MODERATE, "Moderately Skewed").otherwise("Symmetric")
    direction = F.when(a > SKEW_MODERATE, F.when(F.col("s") > 0, "Right").otherwise("Left")).otherwise("N/A")
    transform = (F.when(F.col("feature").isin(TRANSFORM_CATEGORICAL_COLS), "OHE or ordinal (categorical semantics)")
                 .when((a > SKEW_HIGH) & (F.col("s") > 0), "log1p or Box-Cox")
                 .when((a > SKEW_HIGH) & (F.col("s") < 0), "sqrt or reflect+log")
                 .otherwise("StandardScaler"))
    return g.select("feature", sig(F.col("s")).alias("skewness"), sig(F.col("k")).alias("kurtosis"),
                    cat.alias("category"), direction.alias("direction"), transform.alias("transform"))


# B15
def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    g = _long(df, cols).groupBy("feature").agg(
        F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return g.where((F.col("n") >= 2) & (F.col("lo") == F.col("hi"))).select(
        "feature", F.col("lo").alias("value"))


# B16
def quasi_constant(df: DataFrame, cols: Sequence[str] | None = None, share: float = 0.99) -> DataFrame:
    cols = list(cols) if cols is not None else df.columns
    vc = value_counts(df, cols, name="feature", dropna=False)
    g = vc.groupBy("feature").agg(F.max("count").alias("top_n"), F.sum("count").alias("n"),
                                  F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top"))
    return g.select("feature", "top", F.round(F.col("top_n") / F.col("n"), 6).alias("top_share")).where(
        F.col("top_share") > share)


# B17
def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cm = fit_corr_matrix(df, list(cols))
    rows = []
    for (a, b), r in cm.items():
        rows.append((a, b, r))
        rows.append((b, a, r))
    for a in cols:
        rows.append((a, a, 1.0))
    return _small(df.sparkSession, rows, "feature_a string, feature_b string, r double").select(
        "feature_a", "feature_b", sig(F.col("r"), 8).alias("r"))


# B18
def label_correlation(df: DataFrame, cols: Sequence[str], label: str, k: int = 20) -> DataFrame:
    g = _long(df, cols, ids=[label]).groupBy("feature").agg(
        pearson(F.col("value"), c(label).cast("double")).alias("r"))
    g = g.where(F.col("r").isNotNull() & ~F.isnan("r"))
    w = Window.orderBy(F.desc(F.abs("r")), F.asc("feature"))  # one row per feature: tiny
    return g.select("feature", sig(F.col("r"), 8).alias("r"), F.row_number().over(w).alias("rank")).where(
        F.col("rank") <= k)


# B19
def high_corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.85) -> DataFrame:
    cm = fit_corr_matrix(df, list(cols))
    rows = [(a, b, r, b) for (a, b), r in cm.items() if r is not None and abs(r) > threshold]
    return _small(df.sparkSession, rows, "feature_a string, feature_b string, r double, drop_candidate string"
                  ).select("feature_a", "feature_b", sig(F.col("r"), 8).alias("r"), "drop_candidate")


# B20
def gram_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """X^T X over complete rows in one aggregation."""
    comp = df.select(*[clean_double(c(x)).alias(x) for x in cols]).dropna()
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    res = agg_row(comp, {(i, j): F.sum(F.col(cols[i]) * F.col(cols[j])) for i, j in pairs})
    g = np.zeros((len(cols), len(cols)))
    for (i, j), v in res.items():
        g[i, j] = g[j, i] = v if v is not None else 0.0
    return g


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uncentred VIF (no intercept, statsmodels style): VIF_i = G_ii * (G^-1)_ii."""
    g = gram_matrix(df, cols)
    inv = np.linalg.inv(g)
    rows = [(x, float(g[i, i] * inv[i, i])) for i, x in enumerate(cols)]
    return _small(df.sparkSession, rows, "feature string, vif double").select(
        "feature", sig(F.col("vif"), 6).alias("vif"))


# B21
def cardinality_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else string_columns(df, exclude=["Label"])
    n = df.count()
    vc = value_counts(df, cols, name="feature")
    g = vc.groupBy("feature").agg(
        F.count(F.lit(1)).alias("cardinality"),
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("top_value"),
        F.max("count").alias("top_n"))
    strat = (F.when(F.col("cardinality") <= CARD_OHE, "OHE")
             .when(F.col("cardinality") <= CARD_TARGET, "Target/Frequency Encoding")
             .otherwise("Frequency Encoding or Drop"))
    return g.select("feature", "cardinality", strat.alias("strategy"), "top_value",
                    F.round(F.col("top_n") * 100.0 / F.lit(n), 4).alias("top_pct"))


# B22
def protocol_distribution(df: DataFrame, col: str = "Protocol") -> DataFrame:
    g = df.groupBy(c(col).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    name = F.concat(F.lit("Code "), F.col("code").cast("string"))
    for k, v in PROTOCOL_REPORT_NAMES.items():
        name = F.when(F.col("code") == k, F.lit(v)).otherwise(name)
    w = Window.partitionBy()  # one row per protocol code
    return g.select("code", name.alias("name"), "n",
                    F.round(F.col("n") * 100.0 / F.sum("n").over(w), 4).alias("pct"))


# B23
def top_ports(df: DataFrame, col: str = "Destination Port", k: int = 10) -> DataFrame:
    return (df.where(c(col).isNotNull()).groupBy(c(col).alias("port")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("port")).limit(k))


def well_known_ports(df: DataFrame, col: str = "Destination Port") -> DataFrame:
    dim = df.sparkSession.createDataFrame(list(WELL_KNOWN_PORTS.items()), "port int, service string")
    g = df.where(c(col).isin(list(WELL_KNOWN_PORTS))).groupBy(c(col).cast("int").alias("port")).agg(
        F.count(F.lit(1)).alias("n"))
    return F.broadcast(dim).join(g, "port").select("port", "service", "n")  # 8-row dimension


# B24
def flag_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    g = _long(df, cols).groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg((F.col("value") != 0).cast("double")).alias("nz"))
    return g.select("feature", sig(F.col("mean")).alias("mean"), sig(F.col("std")).alias("std"), "min", "max",
                    F.round(F.col("nz") * 100.0, 4).alias("pct_nonzero"),
                    (F.col("min") == F.col("max")).alias("is_constant"))


# B25
def clean_report(before: DataFrame, after: DataFrame, label: str = "Label") -> DataFrame:
    def one(df, stage):
        nums = set(numeric_columns(df))
        miss = sum((F.sum((clean_double(c(x)) if x in nums else c(x)).isNull().cast("long"))
                    for x in df.columns), F.lit(0))
        return df.agg(F.count(F.lit(1)).alias("n_rows"), miss.alias("n_missing"),
                      F.sum(F.coalesce((c(label).cast("string").isin("1", "Malicious")).cast("long"),
                                       F.lit(0))).alias("n_positive")).select(
            F.lit(stage).alias("stage"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
            "n_missing", "n_positive")
    b, a = one(before, "before"), one(after, "after")
    out = b.unionByName(a)
    return out.withColumn("delta_columns", F.when(F.col("stage") == "after",
                                                  F.lit(len(after.columns) - len(before.columns))).otherwise(0))


# B26
def boxplot_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df)
    with held(df, *[c(x) for x in cols]) as d:        # read by several passes
        return _boxplot_stats(d, cols).checkpoint()                # a row per feature


def _boxplot_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    q = quantiles_of(df, cols, [0.25, 0.5, 0.75])
    rows = []
    for x, (q1, med, q3) in q.items():
        if q1 is None:
            continue
        iqr = q3 - q1
        rows.append((x, q1, med, q3, q1 - 1.5 * iqr, q3 + 1.5 * iqr))
    p = _small(df.sparkSession, rows, "feature string, q1 double, median double, q3 double, lo double, hi double")
    lf = _long(df, cols).where(F.col("value").isNotNull()).join(F.broadcast(p), "feature")
    inside = (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))
    return lf.groupBy("feature", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.sum((~inside).cast("long")).alias("n_outliers"))


# B27
def kde(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Gaussian KDE on an equal grid over [min, max], Scott bandwidth n^(-1/5)*std.

    No rows without values; the density is NULL where it has no bandwidth (one value, or all equal).
    """
    x = clean_double(c(col))
    st = agg_row(df, {"lo": F.min(x), "hi": F.max(x), "n": F.count(x), "sd": F.stddev_samp(x)})
    n, sd = st["n"], st["sd"]
    if not n:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    if not sd:
        step = (st["hi"] - st["lo"]) / (points - 1)
        flat = [(i, float(st["lo"] + i * step), None) for i in range(points)]
        return df.sparkSession.createDataFrame(flat, "i int, x double, density double")
    h = (n ** (-0.2)) * sd
    step = (st["hi"] - st["lo"]) / (points - 1)
    grid = st["lo"] + np.arange(points) * step

    def kernel(pdf):
        v = pdf["v"].to_numpy(dtype=float)
        out = np.zeros(points)
        for s0 in range(0, len(v), 2000):
            u = (v[s0:s0 + 2000, None] - grid[None, :]) / h
            out += np.exp(-u * u / 2).sum(axis=0)
        return out

    # every task sums its rows' kernels on the grid: no row is multiplied by the grid points
    total = partition_sums(df.select(x.alias("v")).where("v IS NOT NULL"), kernel, points)
    rows = [(i, float(grid[i]), float(total[i] / n / (h * math.sqrt(2 * math.pi)))) for i in range(points)]
    return df.sparkSession.createDataFrame(rows, "i int, x double, d double").select(
        "i", sig(F.col("x")).alias("x"), sig(F.col("d"), 8).alias("density"))


# B28
def null_label_rows(df: DataFrame, label: str = "Label") -> DataFrame:
    return df.where(c(label).isNull())
