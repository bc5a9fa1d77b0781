"""Catalogue: profiling aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import clean as C
from flowlens.operators import profile as B
from flowlens.plans.q_project import cic_flows, clean_6g_rates
from flowlens.plans.registry import query
from flowlens.plans.sqlkit import (FLOWS_5G_NUMERIC, FLOWS_5G_STRING, FLOWS_6G_NUMERIC, sig,
                                   unpivot_sql)
from flowlens.plans.views import view

F5 = ("flows_5g",)
F6 = ("flows_6g",)
CORR_COLS = ["TotPkts", "SrcPkts", "TotBytes", "SrcBytes", "Load", "Rate", "Loss", "dTtl"]
VIF_COLS = ["TotPkts", "SrcPkts", "Loss"]
FLAG_COLS = ["syn", "fin", "rst", "psh", "urg"]


def v5(spark, sf):
    return view(spark, sf, "flows_5g")


def v6(spark, sf):
    return view(spark, sf, "flows_6g")


@query("dataset_summary", """
SELECT 'flows_5g' AS dataset, CAST(count(*) AS BIGINT) AS n_rows, 20 AS n_columns, 14 AS n_numeric, 6 AS n_categorical FROM flows_5g
UNION ALL SELECT 'flows_6g', CAST(count(*) AS BIGINT), 18, 16, 2 FROM flows_6g""", ("flows_5g", "flows_6g"))
def q_dataset_summary(spark, sf):
    """B1: rows and column-type counts per dataset."""
    return B.dataset_summary({"flows_5g": v5(spark, sf), "flows_6g": v6(spark, sf)})


@query("describe_numeric", f"""
WITH lf AS ({unpivot_sql('flows_5g', FLOWS_5G_NUMERIC)})
SELECT feature, count(value) AS count, {sig('avg(value)')} AS mean, {sig('stddev_samp(value)')} AS std,
 min(value) AS min, {sig('quantile_cont(value, 0.25)')} AS p25, {sig('quantile_cont(value, 0.5)')} AS p50,
 {sig('quantile_cont(value, 0.75)')} AS p75, max(value) AS max
FROM lf GROUP BY feature""", F5)
def q_describe_numeric(spark, sf):
    """B2: count, mean, sample std, min, exact quartiles, max of every numeric column."""
    return B.describe_numeric(v5(spark, sf))


@query("describe_categorical", f"""
WITH lf AS ({unpivot_sql('flows_5g', FLOWS_5G_STRING, value_type='VARCHAR')}),
vc AS (SELECT feature, value, count(*) AS n FROM lf WHERE value IS NOT NULL GROUP BY ALL)
SELECT feature, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", arg_min(value, (-n, value)) AS top, max(n) AS freq
FROM vc GROUP BY feature""", F5)
def q_describe_categorical(spark, sf):
    """Count, unique, top (ties -> smallest), freq of every string column."""
    return B.describe_categorical(v5(spark, sf))


ALL5 = FLOWS_5G_NUMERIC + FLOWS_5G_STRING
ALL5_ORDER = ["UniqueID", "Seq", "Dur", "TotPkts", "SrcPkts", "TotBytes", "SrcBytes", "sMeanPktSz",
              "dMeanPktSz", "Load", "Rate", "Loss", "dTtl", "sVid", "Proto", "State", "sDSb", "dDSb",
              "predicted", "Label"]


@query("missing_report", f"""
WITH lf AS ({unpivot_sql('flows_5g', ALL5_ORDER, value_type='VARCHAR')}),
g AS (SELECT feature, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, count(*) AS n FROM lf GROUP BY feature)
SELECT feature, n_missing, round(CAST(n_missing AS DOUBLE) * 100 / n, 4) AS pct FROM g WHERE n_missing > 0
UNION ALL SELECT '__total__', CAST(sum(n_missing) AS BIGINT), round(CAST(sum(n_missing) AS DOUBLE) * 100 / (max(n) * 20), 4) FROM g""", F5)
def q_missing_report(spark, sf):
    """Missing count and % per column (> 0 only) plus the overall total."""
    return B.missing_report(v5(spark, sf))


STR5 = ["Proto", "State", "sDSb", "dDSb", "predicted", "Label"]


@query("sentinel_report", " UNION ALL ".join(
    f"SELECT '{x}' AS feature, CAST(sum(CASE WHEN {x} = '?' THEN 1 ELSE 0 END) AS BIGINT) AS n_sentinel, "
    f"round(CAST(sum(CASE WHEN {x} = '?' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*), 4) AS pct FROM flows_5g"
    for x in STR5), F5)
def q_sentinel_report(spark, sf):
    """B5: '?' sentinel count and % per string column."""
    return B.sentinel_report(v5(spark, sf))


@query("zero_inf_report", f"""
WITH lf AS ({unpivot_sql('flows_6g', FLOWS_6G_NUMERIC, nan_to_null=False)})
SELECT feature, CAST(sum(CASE WHEN abs(value) = 'Infinity'::DOUBLE THEN 1 ELSE 0 END) AS BIGINT) AS n_inf,
 CAST(sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero,
 round(CAST(sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*), 4) AS pct_zero,
 sum(CASE WHEN value = 0 THEN 1 ELSE 0 END) > count(*) * 0.5 AS zero_inflated
FROM lf GROUP BY feature""", F6)
def q_zero_inf_report(spark, sf):
    """Infinities and zero-inflation (> 50 % zeros) per numeric column."""
    return B.zero_inf_report(v6(spark, sf))


@query("duplicate_report", """
WITH g AS (SELECT *, count(*) AS n FROM flows_6g_replayed GROUP BY ALL HAVING count(*) > 1),
t AS (SELECT count(*) AS n_rows FROM flows_6g_replayed)
SELECT n_rows, CAST(coalesce((SELECT sum(n - 1) FROM g), 0) AS BIGINT) AS n_duplicates,
 (SELECT count(*) FROM g) AS n_groups,
 round(CAST(coalesce((SELECT sum(n - 1) FROM g), 0) AS DOUBLE) * 100 / n_rows, 4) AS pct FROM t""", ("flows_6g", "flows_6g_replayed"))
def q_duplicate_report(spark, sf):
    """Exact duplicates over all columns: count, groups and %."""
    return B.duplicate_report(view(spark, sf, "flows_6g_replayed"))


@query("duplicate_groups", "SELECT *, count(*) AS n_copies FROM flows_6g_replayed GROUP BY ALL HAVING count(*) > 1",
       ("flows_6g", "flows_6g_replayed"))
def q_duplicate_groups(spark, sf):
    """B7 listing: every duplicated row, all columns, with its number of copies."""
    return B.duplicate_groups(view(spark, sf, "flows_6g_replayed"))


@query("label_distribution", """
SELECT Label AS label, count(*) AS n, round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 4) AS pct
FROM flows_6g GROUP BY Label""", F6)
def q_label_distribution(spark, sf):
    """Label counts and % including NULL labels."""
    return B.label_distribution(v6(spark, sf), "Label")


@query("slice_distribution", """
SELECT Label AS dataset, predicted AS slice, count(*) AS n FROM flows_5g GROUP BY ALL""", F5)
def q_slice_distribution(spark, sf):
    """Slice distribution per class."""
    return B.slice_distribution(v5(spark, sf), "Label", "predicted")


TOPK_COLS = ["dst_port", "src", "Label"]


@query("value_counts_topk", f"""
WITH lf AS ({unpivot_sql('flows_6g', TOPK_COLS, value_type='VARCHAR', nan_to_null=False)}),
vc AS (SELECT feature, value, count(*) AS count FROM lf WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY count DESC, value ASC) AS rank FROM vc)
SELECT * FROM r WHERE rank <= 15""", F6)
def q_value_counts_topk(spark, sf):
    """Top-15 value counts per categorical column (ties -> smallest value)."""
    df = v6(spark, sf)
    df = df.select(*[F.col(x).cast("string").alias(x) for x in TOPK_COLS])
    return B.value_counts_topk(df, TOPK_COLS, 15)


HIST_SQL = """
WITH s AS (SELECT min(Load) AS lo, max(Load) AS hi, count(Load) AS n FROM flows_5g),
b AS (SELECT {grp} CAST(least(floor((Load - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin FROM flows_5g, s WHERE Load IS NOT NULL),
spine AS (SELECT {grpsel} CAST(i AS INT) AS bin FROM range(20) t(i) {grpjoin}),
c AS (SELECT {cgrp} bin, count(*) AS count FROM b GROUP BY ALL)
SELECT {grpout} spine.bin, CAST(coalesce(c.count, 0) AS BIGINT) AS count, lo + spine.bin * ((hi - lo) / 20) AS bin_lo,
 lo + (spine.bin + 1) * ((hi - lo) / 20) AS bin_hi {dens}
FROM spine CROSS JOIN s LEFT JOIN c ON spine.bin = c.bin {cjoin}"""


@query("histogram", HIST_SQL.format(grp="", cgrp="", grpsel="", grpjoin="", grpout="", dens="", cjoin=""), F5)
def q_histogram(spark, sf):
    """20 equal-width bins of Load, last bin closed, empty bins kept."""
    return B.histogram(v5(spark, sf), "Load", 20)


@query("histogram_by_class", HIST_SQL.format(
    grp="Label AS grp,", cgrp="grp,", grpsel="g.grp AS grp,", grpjoin="CROSS JOIN (SELECT DISTINCT Label AS grp FROM flows_5g) g",
    grpout="spine.grp AS \"group\",",
    dens=", coalesce(c.count, 0) / (sum(coalesce(c.count, 0)) OVER (PARTITION BY spine.grp) * ((hi - lo) / 20)) AS density",
    cjoin="AND spine.grp = c.grp"), F5)
def q_histogram_by_class(spark, sf):
    """B11 by class with density n / (N_class * width)."""
    return B.histogram(v5(spark, sf), "Load", 20, by="Label", density=True)


SUM_COLS = ["Dur", "TotPkts", "SrcPkts", "TotBytes", "Load", "Rate", "Loss", "dTtl"]


@query("feature_summary", f"""
WITH lf AS ({unpivot_sql('flows_5g', SUM_COLS)}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY feature)
SELECT lf.feature, {sig('avg(value)')} AS mean, any_value(med) AS median, {sig('stddev_samp(value)')} AS std,
 min(value) AS min, max(value) AS max, {sig('skewness(value)')} AS skew,
 CAST(sum(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
FROM lf JOIN q ON lf.feature = q.feature WHERE value IS NOT NULL GROUP BY lf.feature""", F5)
def q_feature_summary(spark, sf):
    """Mean, median, std, min, max, sample skew and IQR outlier count per feature."""
    return B.feature_summary(v5(spark, sf), SUM_COLS)


@query("outlier_report", f"""
WITH lf AS ({unpivot_sql('flows_5g', SUM_COLS)}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, avg(value) AS mu, stddev_pop(value) AS sd FROM lf GROUP BY feature),
g AS (SELECT q.feature, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, count(*) AS n,
  CAST(sum(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_iqr,
  CAST(sum(CASE WHEN sd > 0 AND abs((value - mu) / sd) > 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_z
  FROM lf JOIN q ON lf.feature = q.feature WHERE value IS NOT NULL GROUP BY ALL)
SELECT feature, {sig('q1')} AS q1, {sig('q3')} AS q3, {sig('iqr')} AS iqr, {sig('lower')} AS lower, {sig('upper')} AS upper,
 n_iqr, round(CAST(n_iqr AS DOUBLE) * 100 / n, 4) AS pct_iqr, n_z, round(CAST(n_z AS DOUBLE) * 100 / n, 4) AS pct_z FROM g""", F5)
def q_outlier_report(spark, sf):
    """Tukey fences and |z| > 3 (population std) counts per feature."""
    from flowlens.functions.exprs import sig as ssig
    r = B.outlier_report(v5(spark, sf), SUM_COLS)
    return r.select("feature", *[ssig(F.col(x)).alias(x) for x in ["q1", "q3", "iqr", "lower", "upper"]],
                    "n_iqr", "pct_iqr", "n_z", "pct_z")


SKEW_COLS = [x for x in FLOWS_5G_NUMERIC if x not in ("UniqueID",)]


@query("skew_report", f"""
WITH lf AS ({unpivot_sql('flows_5g', SKEW_COLS)}),
g AS (SELECT feature, skewness(value) * (count(value) - 2) / sqrt(CAST(count(value) AS DOUBLE) * (count(value) - 1)) AS s,
  kurtosis_pop(value) AS k, stddev_samp(value) AS sd, count(value) AS n FROM lf GROUP BY feature)
SELECT feature, {sig('s')} AS skewness, {sig('k')} AS kurtosis,
 CASE WHEN abs(s) > 1 THEN 'Highly Skewed' WHEN abs(s) > 0.5 THEN 'Moderately Skewed' ELSE 'Symmetric' END AS category,
 CASE WHEN abs(s) > 0.5 THEN CASE WHEN s > 0 THEN 'Right' ELSE 'Left' END ELSE 'N/A' END AS direction,
 CASE WHEN feature IN ('sTos', 'dTos') THEN 'OHE or ordinal (categorical semantics)'
      WHEN abs(s) > 1 AND s > 0 THEN 'log1p or Box-Cox' WHEN abs(s) > 1 AND s < 0 THEN 'sqrt or reflect+log'
      ELSE 'StandardScaler' END AS transform
FROM g WHERE n > 1 AND sd > 0""", F5)
def q_skew_report(spark, sf):
    """Population skewness / excess kurtosis with category, direction, transform."""
    return B.skew_report(v5(spark, sf), SKEW_COLS)


@query("constant_columns", f"""
WITH lf AS ({unpivot_sql('flows_6g', FLOWS_6G_NUMERIC)})
SELECT feature, min(value) AS value FROM lf GROUP BY feature HAVING count(value) >= 2 AND min(value) = max(value)""", F6)
def q_constant_columns(spark, sf):
    """Numeric columns with zero sample variance."""
    return B.constant_columns(v6(spark, sf))


QC_COLS = FLOWS_6G_NUMERIC + ["Label"]


@query("quasi_constant", f"""
WITH lf AS ({unpivot_sql('flows_6g', QC_COLS, value_type='VARCHAR', nan_to_null=False)}),
vc AS (SELECT feature, value, count(*) AS n FROM lf GROUP BY ALL),
g AS (SELECT feature, max(n) AS top_n, sum(n) AS tot FROM vc GROUP BY feature)
SELECT feature, round(CAST(top_n AS DOUBLE) / tot, 6) AS top_share FROM g WHERE round(CAST(top_n AS DOUBLE) / tot, 6) > 0.99""", F6)
def q_quasi_constant(spark, sf):
    """Columns whose most frequent value (NULL counted) exceeds 99 %."""
    return B.quasi_constant(v6(spark, sf), QC_COLS).select("feature", "top_share")


def _corr_sql(cols, where=""):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            for x, y in ((a, b), (b, a)):
                parts.append(f"SELECT '{x}' AS feature_a, '{y}' AS feature_b, corr({a}, {b}) AS r FROM flows_5g {where}")
        parts.append(f"SELECT '{a}', '{a}', 1.0::DOUBLE")
    return "WITH m AS (" + "\nUNION ALL ".join(parts) + f")\nSELECT feature_a, feature_b, {sig('r', 8)} AS r FROM m"


@query("corr_matrix", _corr_sql(CORR_COLS), F5)
def q_corr_matrix(spark, sf):
    """Pairwise-complete Pearson correlation matrix (long form)."""
    return B.corr_matrix(v5(spark, sf), CORR_COLS)


@query("label_correlation", f"""
WITH lf AS ({unpivot_sql("(SELECT *, CASE WHEN Label = 'Malicious' THEN 1.0 ELSE 0.0 END AS y FROM flows_5g)", SKEW_COLS, ids=['y'])}),
g AS (SELECT feature, corr(value, y) AS r FROM lf GROUP BY feature),
k AS (SELECT feature, r, row_number() OVER (ORDER BY abs(r) DESC, feature ASC) AS rank FROM g WHERE r IS NOT NULL AND NOT isnan(r))
SELECT feature, {sig('r', 8)} AS r, rank FROM k WHERE rank <= 20""", F5)
def q_label_correlation(spark, sf):
    """Correlation of every numeric feature with the encoded label, top 20."""
    df = C.binarize_label(v5(spark, sf), "Label", "5g")
    return B.label_correlation(df, SKEW_COLS, "Label", 20)


@query("high_corr_pairs", f"""
WITH m AS ({" UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM flows_5g"
                              for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:])})
SELECT feature_a, feature_b, {sig('r', 8)} AS r, feature_b AS drop_candidate FROM m WHERE abs(r) > 0.85""", F5)
def q_high_corr_pairs(spark, sf):
    """Pairs with |r| > 0.85; the second of each pair is the drop candidate."""
    return B.high_corr_pairs(v5(spark, sf), CORR_COLS, 0.85)


def _vif_sql():
    a, b, cc = VIF_COLS
    g = f"""WITH g AS (SELECT sum({a}*{a}) AS g00, sum({a}*{b}) AS g01, sum({a}*{cc}) AS g02, sum({b}*{b}) AS g11,
 sum({b}*{cc}) AS g12, sum({cc}*{cc}) AS g22 FROM flows_5g WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {cc} IS NOT NULL),
d AS (SELECT *, g00*(g11*g22 - g12*g12) - g01*(g01*g22 - g12*g02) + g02*(g01*g12 - g11*g02) AS det FROM g)"""
    return g + f"""
SELECT '{a}' AS feature, {sig('g00 * (g11*g22 - g12*g12) / det', 6)} AS vif FROM d
UNION ALL SELECT '{b}', {sig('g11 * (g00*g22 - g02*g02) / det', 6)} FROM d
UNION ALL SELECT '{cc}', {sig('g22 * (g00*g11 - g01*g01) / det', 6)} FROM d"""


@query("vif", _vif_sql(), F5)
def q_vif(spark, sf):
    """Uncentred variance inflation factors from the Gram matrix (one aggregation)."""
    return B.vif(v5(spark, sf), VIF_COLS)


@query("cardinality_report", f"""
WITH lf AS ({unpivot_sql('flows_5g', [x for x in STR5 if x != 'Label'], value_type='VARCHAR')}),
vc AS (SELECT feature, value, count(*) AS n FROM lf WHERE value IS NOT NULL GROUP BY ALL),
g AS (SELECT feature, count(*) AS cardinality, arg_min(value, (-n, value)) AS top_value, max(n) AS top_n FROM vc GROUP BY feature)
SELECT feature, cardinality, CASE WHEN cardinality <= 10 THEN 'OHE' WHEN cardinality <= 50 THEN 'Target/Frequency Encoding'
 ELSE 'Frequency Encoding or Drop' END AS strategy, top_value,
 round(CAST(top_n AS DOUBLE) * 100 / (SELECT count(*) FROM flows_5g), 4) AS top_pct FROM g""", F5)
def q_cardinality_report(spark, sf):
    """Cardinality, encoding strategy, top value and its share."""
    return B.cardinality_report(v5(spark, sf), [x for x in STR5 if x != "Label"])


@query("protocol_distribution", """
SELECT protocol AS code, CASE protocol WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' WHEN 0 THEN 'Other/Unknown'
 ELSE 'Code ' || CAST(protocol AS VARCHAR) END AS name, count(*) AS n,
 round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 4) AS pct FROM flows_6g GROUP BY protocol""", F6)
def q_protocol_distribution(spark, sf):
    """Protocol code counts with the code -> name map."""
    return B.protocol_distribution(v6(spark, sf), "protocol")


@query("top_ports", """
SELECT dst_port AS port, count(*) AS n FROM flows_6g WHERE dst_port IS NOT NULL GROUP BY dst_port
ORDER BY n DESC, port ASC LIMIT 10""", F6)
def q_top_ports(spark, sf):
    """Top-10 destination ports (ties -> smaller port)."""
    return B.top_ports(v6(spark, sf), "dst_port", 10)


@query("well_known_ports", """
WITH d(port, service) AS (VALUES (80,'HTTP'),(443,'HTTPS'),(22,'SSH'),(53,'DNS'),(21,'FTP'),(25,'SMTP'),(3389,'RDP'),(8080,'HTTP-Alt'))
SELECT d.port, d.service, count(*) AS n FROM flows_6g f JOIN d ON f.dst_port = d.port GROUP BY ALL""", F6)
def q_well_known_ports(spark, sf):
    """Flow counts of the 8 well-known ports present (broadcast 8-row dimension)."""
    return B.well_known_ports(v6(spark, sf), "dst_port")


@query("flag_stats", f"""
WITH lf AS ({unpivot_sql('flows_6g', FLAG_COLS)})
SELECT feature, {sig('avg(value)')} AS mean, {sig('stddev_samp(value)')} AS std, min(value) AS min, max(value) AS max,
 round(avg(CASE WHEN value <> 0 THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_nonzero, min(value) = max(value) AS is_constant
FROM lf GROUP BY feature""", F6)
def q_flag_stats(spark, sf):
    """TCP flag statistics: mean, std, min, max, non-zero %, constant."""
    return B.flag_stats(v6(spark, sf), FLAG_COLS)


@query("clean_report", f"""
SELECT 'before' AS stage, count(*) AS n_rows, 18 AS n_columns,
 CAST(sum(CASE WHEN Label IS NULL THEN 1 ELSE 0 END + CASE WHEN flow_bytes_s IS NULL OR isnan(flow_bytes_s) THEN 1 ELSE 0 END
  + CASE WHEN flow_packets_s IS NULL OR isnan(flow_packets_s) THEN 1 ELSE 0 END + CASE WHEN flow_duration IS NULL THEN 1 ELSE 0 END
  + CASE WHEN fwd_len_mean IS NULL THEN 1 ELSE 0 END + CASE WHEN bwd_len_mean IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
 CAST(0 AS BIGINT) AS n_positive, 0 AS delta_columns FROM flows_6g
UNION ALL
SELECT 'after', count(*), 20,
 CAST(sum(CASE WHEN flow_duration IS NULL THEN 1 ELSE 0 END + CASE WHEN fwd_len_mean IS NULL THEN 1 ELSE 0 END
  + CASE WHEN bwd_len_mean IS NULL THEN 1 ELSE 0 END) AS BIGINT), CAST(0 AS BIGINT), 2 FROM flows_6g WHERE Label IS NOT NULL""", F6)
def q_clean_report(spark, sf):
    """before/after cleaning report (rows, columns, missing, positives, column delta)."""
    before = v6(spark, sf)
    after = clean_6g_rates(before.withColumnRenamed("flow_bytes_s", "Flow Bytes/s")
                           .withColumnRenamed("flow_packets_s", "Flow Packets/s"))
    return B.clean_report(before, after)


@query("boxplot_stats", f"""
WITH lf AS ({unpivot_sql('flows_5g', SUM_COLS)}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM lf GROUP BY feature)
SELECT q.feature, {sig('q1')} AS q1, {sig('median')} AS median, {sig('q3')} AS q3,
 min(CASE WHEN value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1) THEN value END) AS whisker_lo,
 max(CASE WHEN value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1) THEN value END) AS whisker_hi,
 CAST(sum(CASE WHEN value >= q1 - 1.5*(q3-q1) AND value <= q3 + 1.5*(q3-q1) THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM lf JOIN q ON lf.feature = q.feature WHERE value IS NOT NULL GROUP BY ALL""", F5)
def q_boxplot_stats(spark, sf):
    """Five-number summary with whiskers inside the Tukey fences."""
    from flowlens.functions.exprs import sig as ssig
    r = B.boxplot_stats(v5(spark, sf), SUM_COLS)
    return r.select("feature", *[ssig(F.col(x)).alias(x) for x in ["q1", "median", "q3"]],
                    "whisker_lo", "whisker_hi", "n_outliers")


@query("kde", f"""
WITH s AS (SELECT min(fwd_len_mean) AS lo, max(fwd_len_mean) AS hi, count(fwd_len_mean) AS n,
  stddev_samp(fwd_len_mean) AS sd FROM flows_6g),
p AS (SELECT *, pow(n, -0.2) * sd AS h, (hi - lo) / 199 AS step FROM s),
g AS (SELECT CAST(i AS INT) AS i, lo + i * step AS x FROM range(200) t(i), p)
SELECT g.i, {sig('g.x')} AS x, {sig('avg(exp(-((v.fwd_len_mean - g.x) / h) * ((v.fwd_len_mean - g.x) / h) / 2)) / (h * sqrt(2 * pi()))', 8)} AS density
FROM g, p, (SELECT fwd_len_mean FROM flows_6g WHERE fwd_len_mean IS NOT NULL) v GROUP BY g.i, g.x, h""", F6)
def q_kde(spark, sf):
    """Gaussian kernel density on a 200-point grid, Scott bandwidth."""
    return B.kde(v6(spark, sf), "fwd_len_mean", 200)


@query("null_label_rows", "SELECT * FROM flows_6g WHERE Label IS NULL", F6)
def q_null_label_rows(spark, sf):
    """Rows whose label is NULL."""
    return B.null_label_rows(v6(spark, sf), "Label")


_ = cic_flows
