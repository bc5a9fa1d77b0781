"""Catalogue: cleaning and feature engineering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.exprs import sig as ssig
from flowlens.functions.stats import held
from flowlens.operators import clean as C
from flowlens.plans.q_project import cic_flows, clean_6g_rates
from flowlens.plans.registry import query
from flowlens.plans.sqlkit import sig
from flowlens.plans.views import CIC_NAMES, view
from flowlens.session import persist_dealt, persist_input

F5 = ("flows_5g",)
F6 = ("flows_6g",)


def v5(spark, sf):
    return view(spark, sf, "flows_5g")


def v6(spark, sf):
    return view(spark, sf, "flows_6g")


def _sig_cols(df: DataFrame, cols, digits=9) -> DataFrame:
    cols = set(cols)
    return df.select(*[ssig(F.col(f"`{x}`")).alias(x) if x in cols else F.col(f"`{x}`") for x in df.columns])


INF = "'Infinity'::DOUBLE"
V6_COLS = ["flow_id", "src", "ts", "dst_port", "protocol", "flow_duration", "fwd_pkts", "bwd_pkts",
           "fwd_len_mean", "bwd_len_mean", "flow_bytes_s", "flow_packets_s", "syn", "fin", "rst",
           "psh", "urg", "Label"]
V5_COLS = ["UniqueID", "Seq", "Dur", "TotPkts", "SrcPkts", "TotBytes", "SrcBytes", "sMeanPktSz",
           "dMeanPktSz", "Load", "Rate", "Loss", "dTtl", "sVid", "Proto", "State", "sDSb", "dDSb",
           "predicted", "Label"]


@query("drop_null_label", "SELECT * FROM flows_6g WHERE Label IS NOT NULL", F6)
def q_drop_null_label(spark, sf):
    """Drop rows whose label is NULL."""
    return C.drop_null_label(v6(spark, sf))


@query("drop_identifiers", """
SELECT dst_port AS "Destination Port", protocol AS "Protocol", flow_duration AS "Flow Duration",
 fwd_pkts AS "Total Fwd Packets", bwd_pkts AS "Total Backward Packets", fwd_len_mean AS "Fwd Packet Length Mean",
 bwd_len_mean AS "Bwd Packet Length Mean", flow_bytes_s AS "Flow Bytes/s", flow_packets_s AS "Flow Packets/s",
 syn AS "SYN Flag Count", fin AS "FIN Flag Count", rst AS "RST Flag Count", psh AS "PSH Flag Count",
 urg AS "URG Flag Count", Label FROM flows_6g""", F6)
def q_drop_identifiers(spark, sf):
    """Drop the identifier columns that are present (Flow ID, Source IP, Timestamp)."""
    return C.drop_identifiers(cic_flows(spark, sf))


FIXED = C.FIXED_PORTS


@query("port_onehot_fixed", "SELECT flow_id, " + ", ".join(
    f"CAST(coalesce(dst_port = {p}, false) AS INT) AS Port_{p}" for p in FIXED)
    + f", CAST(coalesce(dst_port NOT IN ({', '.join(map(str, FIXED))}), true) AS INT) AS Port_other FROM flows_6g", F6)
def q_port_onehot_fixed(spark, sf):
    """Destination-port one-hot over 8 fixed ports + Port_other."""
    df = C.port_onehot_fixed(cic_flows(spark, sf), "Destination Port", drop_source=True)
    return df.select(F.col("`Flow ID`").alias("flow_id"), *[x for x in df.columns if x.startswith("Port_")])


@query("port_onehot_topn", """
WITH top AS (SELECT dst_port FROM flows_6g WHERE dst_port IS NOT NULL GROUP BY dst_port ORDER BY count(*) DESC, dst_port ASC LIMIT 10)
SELECT flow_id, CASE WHEN dst_port IN (SELECT dst_port FROM top) THEN 'Port_' || CAST(dst_port AS VARCHAR) ELSE 'Port_Other' END AS port_column
FROM flows_6g""", F6)
def q_port_onehot_topn(spark, sf):
    """C4: fit the top-10 ports by frequency (ties -> smaller port), one-hot + Port_Other;
    reported as the one column set per flow."""
    df = cic_flows(spark, sf)
    ports = C.fit_top_ports(df, "Destination Port", 10)
    oh = C.port_onehot_topn(df, ports, "Destination Port")
    pcols = [x for x in oh.columns if x.startswith("Port_")]
    long = oh.select(F.col("`Flow ID`").alias("flow_id"), *pcols).unpivot(
        ["flow_id"], pcols, "port_column", "v")
    return long.where("v = 1").select("flow_id", "port_column")


@query("drop_constant", "SELECT * EXCLUDE (urg) FROM flows_6g", F6)
def q_drop_constant(spark, sf):
    """Fit zero-variance numeric columns and drop them."""
    df = v6(spark, sf)
    return C.drop_columns(df, C.fit_constant_columns(df))


@query("protocol_onehot", """
SELECT flow_id, CAST(protocol = 0 AS INT) AS Proto_Other, CAST(protocol = 6 AS INT) AS Proto_TCP,
 CAST(protocol = 17 AS INT) AS Proto_UDP FROM flows_6g""", F6)
def q_protocol_onehot(spark, sf):
    """Protocol code -> name -> one-hot keeping all categories."""
    df = cic_flows(spark, sf)
    cats = C.fit_protocol_categories(df, "Protocol")
    oh = C.protocol_onehot(df, cats, "Protocol")
    return oh.select(F.col("`Flow ID`").alias("flow_id"), *[x for x in oh.columns if x.startswith("Proto_")])


@query("inf_to_null", f"""
SELECT flow_id, CASE WHEN isnan(flow_bytes_s) OR abs(flow_bytes_s) = {INF} THEN NULL ELSE flow_bytes_s END AS flow_bytes_s,
 CASE WHEN isnan(flow_packets_s) OR abs(flow_packets_s) = {INF} THEN NULL ELSE flow_packets_s END AS flow_packets_s FROM flows_6g""", F6)
def q_inf_to_null(spark, sf):
    """+-Inf and NaN -> NULL on the rate-derived columns."""
    df = C.inf_to_null(v6(spark, sf), ["flow_bytes_s", "flow_packets_s"])
    return df.select("flow_id", "flow_bytes_s", "flow_packets_s")


def _ind_sql(x):
    e = f"CASE WHEN isnan({x}) OR abs({x}) = {INF} THEN NULL ELSE {x} END"
    return f"coalesce({e}, 0.0) AS {x}, CAST(({e}) IS NULL AS INT) AS {x}_was_missing"


@query("missing_indicator", f"SELECT flow_id, {_ind_sql('flow_bytes_s')}, {_ind_sql('flow_packets_s')} FROM flows_6g", F6)
def q_missing_indicator(spark, sf):
    """<c>_was_missing indicator + fill 0 on the rate-derived columns."""
    cols = ["flow_bytes_s", "flow_packets_s"]
    df = C.missing_indicator(C.inf_to_null(v6(spark, sf), cols), cols, fill=0.0)
    return df.select("flow_id", *[y for x in cols for y in (x, f"{x}_was_missing")])


@query("impute_median", f"""
SELECT UniqueID, {sig("coalesce(Dur, (SELECT quantile_cont(Dur, 0.5) FROM flows_5g))")} AS Dur,
 {sig("coalesce(dTtl, (SELECT quantile_cont(dTtl, 0.5) FROM flows_5g))")} AS dTtl,
 {sig("coalesce(sVid, (SELECT quantile_cont(sVid, 0.5) FROM flows_5g))")} AS sVid FROM flows_5g""", F5)
def q_impute_median(spark, sf):
    """Exact medians of the numeric columns with missing values, then fill."""
    df = persist_input(v5(spark, sf))                      # fitted, then filled
    med = C.fit_medians(df)
    out = C.fill_values(df, med).select("UniqueID", *sorted(med))
    return _sig_cols(out, med)


@query("drop_sparse", "SELECT * EXCLUDE (sVid) FROM flows_5g", F5)
def q_drop_sparse(spark, sf):
    """Drop columns with more than 75 % missing."""
    df = v5(spark, sf)
    return C.drop_columns(df, C.fit_sparse_columns(df, 0.75))


@query("impute_zero", "SELECT UniqueID, coalesce(dTtl, 0.0) AS dTtl FROM flows_5g", F5)
def q_impute_zero(spark, sf):
    """C11: zero-sentinel imputation (bound to dTtl: the stand-in has no TCP base columns)."""
    return C.impute_zero(v5(spark, sf), ["dTtl"]).select("UniqueID", "dTtl")


@query("drop_useless", "SELECT * EXCLUDE (UniqueID, Seq, sVid) FROM flows_5g", F5)
def q_drop_useless(spark, sf):
    """Drop configured non-informative columns (Global keeps the slice column)."""
    return C.drop_useless(v5(spark, sf), "Global")


@query("sentinel_to_mode", """
WITH m AS (SELECT sDSb AS v FROM flows_5g WHERE sDSb <> '?' AND sDSb IS NOT NULL GROUP BY sDSb ORDER BY count(*) DESC, sDSb ASC LIMIT 1)
SELECT UniqueID, CASE WHEN sDSb = '?' THEN (SELECT v FROM m) ELSE sDSb END AS sDSb FROM flows_5g""", F5)
def q_sentinel_to_mode(spark, sf):
    """C13: '?' -> mode of the remaining values (ties -> smallest)."""
    df = v5(spark, sf)
    mode = C.fit_sentinel_mode(df, "sDSb")
    return C.replace_value(df, "sDSb", "?", mode).select("UniqueID", "sDSb")


@query("sentinel_to_unknown", "SELECT UniqueID, CASE WHEN dDSb = '?' THEN 'unknown' ELSE dDSb END AS dDSb FROM flows_5g", F5)
def q_sentinel_to_unknown(spark, sf):
    """C14: '?' -> 'unknown'."""
    return C.sentinel_to_unknown(v5(spark, sf), "dDSb").select("UniqueID", "dDSb")


@query("dedup_exact", "SELECT DISTINCT * FROM flows_6g", F6)
def q_dedup_exact(spark, sf):
    """Exact duplicate removal over all columns."""
    return C.dedup_exact(v6(spark, sf))


@query("select_by_keywords", "SELECT fwd_pkts, fwd_len_mean, bwd_pkts, bwd_len_mean, flow_packets_s FROM flows_6g", F6)
def q_select_by_keywords(spark, sf):
    """The columns whose CIC names hold 'packet', over the whole table."""
    df = cic_flows(spark, sf)
    names = C.select_by_keywords(df.columns, ["packet"])
    back = {v: k for k, v in CIC_NAMES.items()}
    return df.select(*[F.col(f"`{x}`").alias(back[x]) for x in names])


@query("drop_groups", "SELECT * EXCLUDE (SrcPkts) FROM flows_5g", F5)
def q_drop_groups(spark, sf):
    """Configured correlated-group drop (src variant, which also removes SrcPkts)."""
    return C.drop_groups(v5(spark, sf), [*C.CORR_GROUPS_5G, C.CORR_GROUPS_5G_SRC_EXTRA])


CORR6 = ["Destination Port", "Protocol", "Flow Duration", "Total Fwd Packets", "Total Backward Packets",
         "Fwd Packet Length Mean", "Bwd Packet Length Mean", "Flow Bytes/s", "Flow Packets/s",
         "SYN Flag Count", "FIN Flag Count", "RST Flag Count", "PSH Flag Count"]
CORR6_SRC = ["dst_port", "protocol", "flow_duration", "fwd_pkts", "bwd_pkts", "fwd_len_mean", "bwd_len_mean",
             "flow_bytes_s", "flow_packets_s", "syn", "fin", "rst", "psh"]
PROT6 = {"fwd_pkts", "bwd_pkts", "fwd_len_mean", "bwd_len_mean"}


def _drop_corr_sql():
    cleaned = ("(SELECT *, CASE WHEN isnan(flow_bytes_s) OR abs(flow_bytes_s) = 'Infinity'::DOUBLE THEN NULL ELSE flow_bytes_s END AS fb,"
               " CASE WHEN isnan(flow_packets_s) OR abs(flow_packets_s) = 'Infinity'::DOUBLE THEN NULL ELSE flow_packets_s END AS fp"
               " FROM flows_6g WHERE Label IS NOT NULL)")
    src = {"flow_bytes_s": "coalesce(fb, 0.0)", "flow_packets_s": "coalesce(fp, 0.0)"}
    names = ", ".join(f"({i}, '{n}', {str(s in PROT6).lower()})" for i, (n, s) in enumerate(zip(CORR6, CORR6_SRC)))
    pairs = []
    for i, a in enumerate(CORR6_SRC):
        for j in range(i + 1, len(CORR6_SRC)):
            b = CORR6_SRC[j]
            ea, eb = src.get(a, a), src.get(b, b)
            pairs.append(f"SELECT {i} AS i, {j} AS j, corr({ea}, {eb}) AS r FROM {cleaned} c")
    return f"""
WITH cols(pos, name, prot) AS (VALUES {names}),
pr AS ({' UNION ALL '.join(pairs)}),
firstp AS (SELECT j, min(i) AS i FROM pr WHERE abs(r) > 0.90 GROUP BY j)
SELECT c.name AS feature, (NOT c.prot AND f.i IS NOT NULL AND NOT p.prot) AS dropped
FROM cols c LEFT JOIN firstp f ON f.j = c.pos LEFT JOIN cols p ON p.pos = f.i"""


@query("drop_correlated", _drop_corr_sql(), F6)
def q_drop_correlated(spark, sf):
    """C17: greedy correlation drop (|r| > 0.90) with protected directional pairs."""
    df = clean_6g_rates(cic_flows(spark, sf))
    corr = C.fit_corr_matrix(df, CORR6)
    drops = set(C.greedy_correlation_drop(CORR6, corr, 0.90))
    kept = C.drop_columns(df, sorted(drops))
    return spark.createDataFrame([(x, x not in set(kept.columns)) for x in CORR6], "feature string, dropped boolean")


@query("loss_ratio", "SELECT UniqueID, SrcPkts / (TotPkts + 1) AS SrcPkts_ratio FROM flows_5g", F5)
def q_loss_ratio(spark, sf):
    """Asymmetry ratio part / (total + 1), part dropped (bound to SrcPkts / TotPkts)."""
    return C.asymmetry_ratio(v5(spark, sf), "SrcPkts", "TotPkts").select("UniqueID", "SrcPkts_ratio")


CAP5 = [x for x in C.CAP_COLUMNS_5G if x in V5_COLS]


def _q(x, p):
    return f"(SELECT quantile_cont({x}, {p}) FROM flows_5g)"


@query("winsorize", "SELECT UniqueID, " + ", ".join(
    f"CASE WHEN {x} < {_q(x, 0.01)} THEN {_q(x, 0.01)} WHEN {x} > {_q(x, 0.99)} THEN {_q(x, 0.99)} ELSE {x} END AS {x}"
    for x in CAP5) + " FROM flows_5g", F5)
def q_winsorize(spark, sf):
    """Winsorise the 5G cap list at P1 / P99 (exact linear quantiles)."""
    df = persist_input(v5(spark, sf).select("UniqueID", *CAP5))       # fitted, then clipped
    b = C.fit_winsor_bounds(df, CAP5)
    return C.winsorize(df, b).select("UniqueID", *CAP5)


@query("winsorize_report", " UNION ALL ".join(
    f"SELECT '{x}' AS feature, CAST(sum(CASE WHEN {x} < {_q(x, 0.01)} OR {x} > {_q(x, 0.99)} THEN 1 ELSE 0 END) AS BIGINT) AS n_capped, "
    f"{sig(_q(x, 0.01))} AS p01, {sig(_q(x, 0.99))} AS p99, {sig(f'avg({x})')} AS mean_before, "
    f"{sig(f'avg(CASE WHEN {x} < {_q(x, 0.01)} THEN {_q(x, 0.01)} WHEN {x} > {_q(x, 0.99)} THEN {_q(x, 0.99)} ELSE {x} END)')} AS mean_after FROM flows_5g"
    for x in CAP5), F5)
def q_winsorize_report(spark, sf):
    """C19 report: n capped, bounds, mean before / after."""
    with held(v5(spark, sf), *map(F.col, CAP5)) as df:
        r = C.winsorize_report(df, C.fit_winsor_bounds(df, CAP5))
    return _sig_cols(r, ["p01", "p99", "mean_before", "mean_after"])


LOG5 = [x for x in C.LOG_FULL_5G if x in V5_COLS]


def _bc_llf(xexpr, kexpr):
    lam = f"(CAST({kexpr} AS DOUBLE) / 1000)"
    y = f"(CASE WHEN {kexpr} = 0 THEN ln({xexpr}) ELSE (pow({xexpr}, {lam}) - 1) / {lam} END)"
    return f"({lam} - 1) * sum(ln({xexpr})) - CAST(count({xexpr}) AS DOUBLE) / 2 * ln(var_pop({y}))"


def log_plan_sql(src: str, cols, with_bc=True) -> str:
    """Oracle CTEs: per column skew gating and the 3-stage Box-Cox lambda search."""
    lf = " UNION ALL ".join(f"SELECT '{x}' AS feature, CAST({x} AS DOUBLE) AS v FROM {src}" for x in cols)
    xl = "ln(1 + CASE WHEN v < 0 THEN 0.0 ELSE v END)"
    parts = [f"lf AS ({lf})",
             f"sk AS (SELECT feature, skewness(v) AS sb, skewness({xl}) AS sl FROM lf GROUP BY feature)",
             "m AS (SELECT feature, sb, CASE WHEN sb IS NULL OR abs(sb) <= 1 THEN NULL ELSE sl END AS sl,"
             " CASE WHEN sb IS NULL OR abs(sb) <= 1 THEN 'none' WHEN " +
             ("abs(sl) > 1 THEN 'log1p + BoxCox' " if with_bc else "false THEN '' ") + "ELSE 'log1p' END AS method FROM sk)"]
    x = f"({xl} + 1e-6)"
    prev = None
    for s, step in enumerate((200, 20, 2), 1):
        center = "0" if prev is None else f"{prev}.c"
        join = "" if prev is None else f" JOIN {prev} ON {prev}.feature = lf.feature"
        parts.append(
            f"g{s} AS (SELECT feature, k, {_bc_llf(x, 'k')} AS llf FROM (SELECT lf.feature, lf.v, {center} + {step} * (j - 10) AS k"
            f" FROM lf{join} CROSS JOIN range(21) r(j) WHERE lf.feature IN (SELECT feature FROM m WHERE method = 'log1p + BoxCox')) t"
            f" GROUP BY feature, k)")
        parts.append(f"b{s} AS (SELECT feature, arg_min(k, (-llf, k)) AS c FROM g{s} WHERE NOT isnan(llf) GROUP BY feature)")
        prev = f"b{s}"
    parts.append("plan AS (SELECT m.*, CAST(b3.c AS DOUBLE) / 1000 AS lam FROM m LEFT JOIN b3 ON b3.feature = m.feature)")
    return "WITH " + ",\n".join(parts)


@query("log_report", log_plan_sql("flows_5g", LOG5) + f"""
SELECT feature AS "column", {sig('sb')} AS skew_before, {sig('sl')} AS skew_log, method, lam AS "lambda" FROM plan""", F5)
def q_log_report(spark, sf):
    """C20/C21 report: pandas skew before / after log1p, method, Box-Cox lambda."""
    plan = C.fit_log_transform(v5(spark, sf), LOG5, [])
    df = spark.createDataFrame([(e["column"], e["skew_before"], e["skew_log"], e["method"], e["lambda"]) for e in plan],
                               "column string, skew_before double, skew_log double, method string, lambda double")
    return _sig_cols(df, ["skew_before", "skew_log"])


@query("log_transform", log_plan_sql("flows_5g", LOG5) + f""",
lv AS ({' UNION ALL '.join(f"SELECT UniqueID, '{x}' AS feature, CAST({x} AS DOUBLE) AS v FROM flows_5g" for x in LOG5)})
SELECT lv.UniqueID, CASE WHEN p.method = 'none' THEN lv.feature ELSE lv.feature || '_log' END AS feature,
 {sig("CASE WHEN p.method = 'none' THEN lv.v WHEN p.method = 'log1p' THEN ln(1 + CASE WHEN lv.v < 0 THEN 0.0 ELSE lv.v END) "
      "WHEN p.lam = 0 THEN ln(ln(1 + CASE WHEN lv.v < 0 THEN 0.0 ELSE lv.v END) + 1e-6) "
      "ELSE (pow(ln(1 + CASE WHEN lv.v < 0 THEN 0.0 ELSE lv.v END) + 1e-6, p.lam) - 1) / p.lam END")} AS value
FROM lv JOIN plan p ON p.feature = lv.feature""", F5)
def q_log_transform(spark, sf):
    """Skew-gated log1p(max(x,0)) -> <c>_log, Box-Cox fallback (long form)."""
    df = persist_dealt(v5(spark, sf).select("UniqueID", *LOG5))        # the fit and the result read it
    out = C.log_transform(df, C.fit_log_transform(df, LOG5, []))
    cols = [x for x in out.columns if x in LOG5 or (x.endswith("_log") and x[:-4] in LOG5)]
    long = out.select("UniqueID", *[F.col(x).cast("double") for x in cols]).unpivot(
        ["UniqueID"], cols, "feature", "value")
    return long.select("UniqueID", "feature", ssig(F.col("value")).alias("value"))


@query("boxcox_llf", f"""
WITH x AS (SELECT ln(1 + CASE WHEN Load < 0 THEN 0.0 ELSE Load END) + 1e-6 AS x FROM flows_5g)
SELECT CAST(k AS DOUBLE) / 1000 AS "lambda", {sig(_bc_llf('x', 'k'), 8)} AS llf
FROM x CROSS JOIN (SELECT -2000 + 200 * j AS k FROM range(21) r(j)) g GROUP BY k""", F5)
def q_boxcox_llf(spark, sf):
    """Box-Cox profile log-likelihood over the 21-point stage-1 grid of log1p(Load)."""
    df = v5(spark, sf)
    x = C.log1p_clip(F.col("Load")) + F.lit(C.BOXCOX_EPS_SMALL)
    t = C.boxcox_llf_table(df, x, C.boxcox_stage_points(0, C.BOXCOX_STAGES[0]))
    return t.select("lambda", ssig(F.col("llf"), 8).alias("llf"))


@query("log1p_only", log_plan_sql("flows_5g", ["Loss", "SrcPkts"], with_bc=False) + f""",
lv AS (SELECT UniqueID, 'Loss' AS feature, Loss AS v FROM flows_5g UNION ALL SELECT UniqueID, 'SrcPkts', SrcPkts FROM flows_5g)
SELECT lv.UniqueID, CASE WHEN p.method = 'none' THEN lv.feature ELSE lv.feature || '_log' END AS feature,
 {sig("CASE WHEN p.method = 'none' THEN lv.v ELSE ln(1 + CASE WHEN lv.v < 0 THEN 0.0 ELSE lv.v END) END")} AS value
FROM lv JOIN plan p ON p.feature = lv.feature""", F5)
def q_log1p_only(spark, sf):
    """Skew-gated log1p without Box-Cox (TCP-window rule, bound to Loss / SrcPkts)."""
    df = C.log1p_only(v5(spark, sf), ["Loss", "SrcPkts"])
    cols = [x for x in df.columns if x in ("Loss", "SrcPkts", "Loss_log", "SrcPkts_log")]
    long = df.select("UniqueID", *[F.col(x).cast("double") for x in cols]).unpivot(["UniqueID"], cols, "feature", "value")
    return long.select("UniqueID", "feature", ssig(F.col("value")).alias("value"))


@query("onehot_drop_first", """
SELECT UniqueID, CAST(Proto = 'tcp' AS INT) AS Proto_tcp, CAST(Proto = 'udp' AS INT) AS Proto_udp,
 CAST(State = 'FIN' AS INT) AS State_FIN, CAST(State = 'RST' AS INT) AS State_RST,
 CAST(dDSb = 'cs0' AS INT) AS dDSb_cs0 FROM flows_5g""", F5)
def q_onehot_drop_first(spark, sf):
    """One-hot with the first (lexicographic) category dropped."""
    df = v5(spark, sf).select("UniqueID", "Proto", "State", "dDSb")
    return C.onehot(df, C.fit_categories(df, ["Proto", "State", "dDSb"]), drop_first=True)


@query("ordinal_encode", """
WITH d AS (SELECT sDSb, CAST(row_number() OVER (ORDER BY sDSb) - 1 AS INT) AS code FROM (SELECT DISTINCT sDSb FROM flows_5g WHERE sDSb IS NOT NULL))
SELECT f.UniqueID, coalesce(d.code, -1) AS sDSb FROM flows_5g f LEFT JOIN d ON f.sDSb = d.sDSb""", F5)
def q_ordinal_encode(spark, sf):
    """Ordinal codes over sorted categories (missing -> -1)."""
    return C.ordinal_codes(v5(spark, sf).select("UniqueID", "sDSb"), ["sDSb"])


@query("binary_indicator", "SELECT UniqueID, CAST(coalesce(sDSb = 'cs0', false) AS INT) AS sDSb_is_cs0 FROM flows_5g", F5)
def q_binary_indicator(spark, sf):
    """Binary indicator for the dominant value, source dropped."""
    return C.binary_indicator(v5(spark, sf), "sDSb", "cs0").select("UniqueID", "sDSb_is_cs0")


@query("rename_code", "SELECT UniqueID, dTtl AS dTtl_code FROM flows_5g", F5)
def q_rename_code(spark, sf):
    """Rename to mark code semantics (bound to dTtl)."""
    return C.rename_code(v5(spark, sf), ["dTtl"]).select("UniqueID", "dTtl_code")


@query("binarize_label", "SELECT UniqueID, CASE Label WHEN 'Benign' THEN 0 WHEN 'Malicious' THEN 1 END AS Label FROM flows_5g", F5)
def q_binarize_label(spark, sf):
    """5G label map Benign -> 0, Malicious -> 1."""
    return C.binarize_label(v5(spark, sf), "Label", "5g").select("UniqueID", "Label")


@query("binarize_label_6g", "SELECT flow_id, CAST(lower(Label) <> 'benign' AS INT) AS Label FROM flows_6g", F6)
def q_binarize_label_6g(spark, sf):
    """6G rule, case-insensitive label != 'benign' -> 1 (NULL stays NULL)."""
    return C.binarize_label(v6(spark, sf), "Label", "6g").select("flow_id", "Label")


@query("align_schema", """
SELECT UniqueID, CAST(Proto = 'tcp' AS INT) AS Proto_tcp, CAST(Proto = 'udp' AS INT) AS Proto_udp,
 CAST(State = 'FIN' AS INT) AS State_FIN, CAST(State = 'RST' AS INT) AS State_RST, 0 AS Cause_x
FROM flows_5g WHERE predicted = '1:eMBB'""", F5)
def q_align_schema(spark, sf):
    """One-hot a slice separately, then align it to the Global column list
    (missing -> 0, extras dropped, Global order)."""
    df = v5(spark, sf).select("UniqueID", "Proto", "State", "predicted")
    glob = C.onehot(df.drop("predicted"), C.fit_categories(df, ["Proto", "State"]), drop_first=True)
    reference = glob.columns + ["Cause_x"]
    sl = df.where("predicted = '1:eMBB'").drop("predicted")
    sl = C.onehot(sl, C.fit_categories(sl, ["Proto", "State"]), drop_first=True)
    return C.align_schema(sl, reference, 0)


SCALE5 = ["Seq", "Dur", "TotPkts", "SrcPkts", "TotBytes", "SrcBytes", "sMeanPktSz", "dMeanPktSz", "Load",
          "Rate", "Loss", "dTtl", "sVid"]


@query("standard_scale", "WITH s AS (SELECT " + ", ".join(
    f"avg({x}) AS m_{x}, CASE WHEN stddev_pop({x}) = 0 OR stddev_pop({x}) IS NULL THEN 1.0 ELSE stddev_pop({x}) END AS s_{x}"
    for x in SCALE5) + " FROM flows_5g) SELECT UniqueID, " + ", ".join(
    sig(f"({x} - m_{x}) / s_{x}", 5) + f" AS {x}" for x in SCALE5) + " FROM flows_5g, s", F5)
def q_standard_scale(spark, sf):
    """(x - mean) / population std, zero std -> 1, exclusions by name pattern."""
    df = v5(spark, sf)
    cols = C.scale_columns(df, exclude=["UniqueID"])
    out = C.standard_scale(df, C.fit_standard_scaler(df, cols)).select("UniqueID", *cols)
    return out.select("UniqueID", *[ssig(F.col(x), 5).alias(x) for x in cols])


@query("minmax_scale", """
WITH s AS (SELECT min(flow_duration) AS a, max(flow_duration) AS b, min(fwd_pkts) AS c, max(fwd_pkts) AS d FROM flows_6g)
SELECT flow_id, (flow_duration - a) / (b - a) AS flow_duration, (fwd_pkts - c) / (d - c) AS fwd_pkts FROM flows_6g, s""", F6)
def q_minmax_scale(spark, sf):
    """Min-max scaling."""
    df = v6(spark, sf)
    return C.minmax_scale(df, C.fit_minmax(df, ["flow_duration", "fwd_pkts"])).select(
        "flow_id", "flow_duration", "fwd_pkts")


@query("prefer_log", f"SELECT UniqueID, {sig('ln(1 + TotPkts)')} AS TotPkts_log, SrcPkts FROM flows_5g", F5)
def q_prefer_log(spark, sf):
    """Drop the raw column when <c>_log exists."""
    df = v5(spark, sf).select("UniqueID", "TotPkts", "SrcPkts")
    df = df.withColumn("TotPkts_log", ssig(F.log1p("TotPkts")))
    return C.prefer_log(df)


@query("sanitize", f"""
SELECT flow_id, coalesce(CASE WHEN isnan(flow_bytes_s) OR abs(flow_bytes_s) = {INF} THEN NULL ELSE flow_bytes_s END, 0.0) AS u_byte_rate,
 coalesce(flow_packets_s, 0.0) AS u_pkt_rate, coalesce(flow_duration, 0.0) AS u_duration FROM flows_6g""", F6)
def q_sanitize(spark, sf):
    """NULL / NaN / +-Inf -> 0 on projected features just before a model."""
    from flowlens.operators.project import project_6g
    p = project_6g(cic_flows(spark, sf), keep=["Flow ID"]).withColumnRenamed("Flow ID", "flow_id")
    return C.sanitize(p, ["u_byte_rate", "u_pkt_rate", "u_duration"]).select(
        "flow_id", "u_byte_rate", "u_pkt_rate", "u_duration")


@query("coerce_numeric", "SELECT UniqueID, TotPkts, TRY_CAST(sDSb AS DOUBLE) AS sDSb FROM flows_5g", F5)
def q_coerce_numeric(spark, sf):
    """Coercing numeric cast, malformed values -> NULL."""
    return C.coerce_numeric(v5(spark, sf), ["TotPkts", "sDSb"]).select("UniqueID", "TotPkts", "sDSb")


@query("pipeline_6g")
def q_pipeline_6g(spark, sf):
    """The 6G cleaning pipeline N1-N10 over the CIC flows (each step is oracle-checked
    on its own above); returns the cleaned, scaled table."""
    from flowlens.operators.pipelines import pipeline_6g
    out, _params = pipeline_6g(cic_flows(spark, sf))
    return out


@query("pipeline_5g")
def q_pipeline_5g(spark, sf):
    """The 5G cleaning pipeline (steps 1-9, notebook variant) over Global and its three slices, each
    with its own parameters, aligned to the Global columns."""
    from flowlens.operators.pipelines import pipeline_5g_family
    out, _params = pipeline_5g_family(v5(spark, sf))
    return out
