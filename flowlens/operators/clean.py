"""Cleaning and feature-engineering operators.

Data-dependent steps are split into ``fit_*`` (one aggregate job returning a
small, JSON-serialisable parameter dict) and a transform that only builds
column expressions.  Output schemas that depend on the data (one-hots,
drops) are therefore decided on the driver from fitted parameters, and a fit
on one table can be applied unchanged to another (train/serve, streaming).
Each transform is a single ``select`` so consecutive steps fuse into one
codegen stage.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.stats import (agg_row, c, clean_double, cumulative, held, numeric_columns,
                                      partition_sums, quantiles_of, sample_skew_from_pop, top_value)

# ---------------------------------------------------------------- fixed values
IDENTIFIERS_6G = ["Flow ID", "Source IP", "Destination IP", "Timestamp", "External IP",
                  "Source Port"]
FIXED_PORTS = [80, 443, 22, 53, 21, 25, 3389, 8080]
TOP_N_PORTS = 10
PROTOCOL_NAMES = {6: "TCP", 17: "UDP", 0: "Other"}
RATE_DERIVED_6G = ["Flow Bytes/s", "Flow Packets/s"]
HIGH_MISSING_THRESHOLD = 0.75
ALWAYS_DROP_5G = ["sVid", "dVid", "SrcGap", "DstGap", "X", "UniqueID", "Seq"]
SLICE_ONLY_DROP_5G = ["predicted"]
INFORMATIVE_MISSING_5G = ["dTos", "dTtl", "dHops", "DstTCPBase", "SrcTCPBase"]
MEDIAN_IMPUTE_5G = ["dTos", "dTtl", "dHops", "DstWin", "SrcWin", "sTos", "sTtl", "sHops"]
ZERO_SENTINEL_5G = ["DstTCPBase", "SrcTCPBase"]
# correlated groups removed in the 5G notebook variant (SrcLoss handled by the ratio)
CORR_GROUPS_5G = [["DstLoad", "DstRate"], ["SrcRate"], ["RunTime", "Sum"], ["DstPkts", "DstBytes"], ["DstLoss"]]
# the src variant also removes these
CORR_GROUPS_5G_SRC_EXTRA = ["SrcPkts", "SrcLoss", "pDup"]
PROTECTED_PAIRS_6G = [
    ("Total Fwd Packets", "Total Backward Packets"),
    ("Fwd Packet Length Mean", "Bwd Packet Length Mean"),
    ("Fwd Header Length", "Bwd Header Length"),
    ("Fwd IAT Total", "Bwd IAT Total"),
]
CAP_COLUMNS_5G = ["TotPkts", "TotBytes", "Loss", "Load", "SrcLoad", "Rate", "SrcPkts",
                  "SrcBytes", "sMeanPktSz", "dMeanPktSz", "Offset", "pLoss", "TcpRtt",
                  "SynAck", "AckDat", "DstWin", "SrcWin"]
LOG_FULL_5G = ["Load", "SrcLoad", "Rate", "SynAck", "TcpRtt", "AckDat", "SrcBytes", "Loss",
               "SrcPkts", "sMeanPktSz", "dMeanPktSz", "TotBytes", "pLoss", "Offset",
               "TotPkts", "Mean", "Min", "Max"]
LOG1P_ONLY_5G = ["SrcWin", "DstWin"]
SKEW_THRESHOLD = 1.0
BOXCOX_EPS_SMALL = 1e-6
ONEHOT_5G = ["Proto", "State", "Cause", "dDSb"]
LABEL_MAP_5G = {"Benign": 0, "Malicious": 1}
SCALE_EXCLUDE_PREFIXES = ("Proto_", "Port_")
SCALE_EXCLUDE_SUFFIXES = ("_was_missing",)
SCALE_EXCLUDE_CONTAINS = ("Flag Count",)
# ----------------------------------------------------------------------------


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    s = set(df.columns)
    return [n for n in names if n in s]


def _replace(df: DataFrame, new: dict[str, Column], drop: Iterable[str] = ()) -> DataFrame:
    """One select: replace/append columns in ``new``, drop ``drop``."""
    dropset = set(drop)
    out = []
    for x in df.columns:
        if x in dropset:
            continue
        out.append(new[x].alias(x) if x in new else c(x))
    out += [e.alias(k) for k, e in new.items() if k not in set(df.columns)]
    return df.select(*out)


def excluded_from_scaling(name: str) -> bool:
    return (name.startswith(SCALE_EXCLUDE_PREFIXES) or name.endswith(SCALE_EXCLUDE_SUFFIXES)
            or any(t in name for t in SCALE_EXCLUDE_CONTAINS) or name == "Label")


def select_by_keywords(columns: Sequence[str], keywords: Sequence[str]) -> list[str]:
    """Case-insensitive substring selection of column names."""
    kws = [k.lower() for k in keywords]
    return [x for x in columns if any(k in x.lower() for k in kws)]


# C1 ------------------------------------------------------------------------
def drop_null_label(df: DataFrame, label: str = "Label") -> DataFrame:
    return df.where(c(label).isNotNull())


# C2 ------------------------------------------------------------------------
def drop_identifiers(df: DataFrame, names: Sequence[str] = IDENTIFIERS_6G) -> DataFrame:
    return df.drop(*_present(df, names))


# C3 ------------------------------------------------------------------------
def port_onehot_fixed(df: DataFrame, col: str = "Destination Port",
                      ports: Sequence[int] = FIXED_PORTS, drop_source: bool = False) -> DataFrame:
    if col not in df.columns:
        return df
    p = c(col)
    new = {f"Port_{v}": F.coalesce((p == v).cast("int"), F.lit(0)) for v in ports}
    new["Port_other"] = F.coalesce((~p.isin(list(ports))).cast("int"), F.lit(1))
    return _replace(df, new, [col] if drop_source else [])


# C4 ------------------------------------------------------------------------
def fit_top_ports(df: DataFrame, col: str = "Destination Port", n: int = TOP_N_PORTS) -> list[int]:
    rows = (df.where(c(col).isNotNull()).groupBy(c(col).alias("p")).count()
            .orderBy(F.desc("count"), F.asc("p")).limit(n).collect())
    return [int(r["p"]) for r in rows]


def port_onehot_topn(df: DataFrame, ports: Sequence[int], col: str = "Destination Port") -> DataFrame:
    p = c(col)
    new = {f"Port_{int(v)}": F.coalesce((p == v).cast("int"), F.lit(0)) for v in ports}
    new["Port_Other"] = F.coalesce((~p.isin([int(v) for v in ports])).cast("int"), F.lit(1))
    return _replace(df, new, [col])


# C5 / B15 -------------------------------------------------------------------
def fit_constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Numeric columns whose sample std is 0 (>= 2 values, all equal)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    exprs = {}
    for x in cols:
        v = clean_double(c(x))
        exprs[x] = (F.count(v) >= 2) & (F.min(v) == F.max(v))
    res = agg_row(df, exprs)
    return [x for x in cols if res[x]]


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*_present(df, cols))


# C6 ------------------------------------------------------------------------
def protocol_label(col: Column) -> Column:
    e = F.concat(F.lit("Proto_"), col.cast("bigint").cast("string"))
    for code, name in PROTOCOL_NAMES.items():
        e = F.when(col == code, F.lit(name)).otherwise(e)
    return e


def fit_protocol_categories(df: DataFrame, col: str = "Protocol") -> list[str]:
    rows = df.select(protocol_label(c(col)).alias("v")).where("v IS NOT NULL").distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError("too many protocol codes to become columns")
    return sorted(r["v"] for r in rows)


def protocol_onehot(df: DataFrame, categories: Sequence[str], col: str = "Protocol") -> DataFrame:
    lab = protocol_label(c(col))
    new = {f"Proto_{v}": F.coalesce((lab == v).cast("int"), F.lit(0)) for v in categories}
    return _replace(df, new, [col])


# C7 ------------------------------------------------------------------------
def inf_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    new = {}
    for x in _present(df, cols):
        d = c(x).cast("double")
        new[x] = F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(d)
    return _replace(df, new)


# C8 ------------------------------------------------------------------------
def fit_missing_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    cols = _present(df, cols)
    res = agg_row(df, {x: F.max(clean_double(c(x)).isNull().cast("int")) for x in cols})
    return [x for x in cols if res[x] == 1]


def missing_indicator(df: DataFrame, cols: Sequence[str], fill: dict | float | None = None) -> DataFrame:
    """Add ``<c>_was_missing`` for each column; optionally fill the column.

    ``fill`` is a constant, a ``{column: value}`` map (e.g. fitted medians) or None.
    """
    new = {}
    for x in _present(df, cols):
        d = clean_double(c(x))
        if fill is not None:
            v = fill.get(x) if isinstance(fill, dict) else fill
            if v is not None:
                new[x] = F.coalesce(d, F.lit(float(v)))
        new[f"{x}_was_missing"] = d.isNull().cast("int")
    return _replace(df, new)


# C9 ------------------------------------------------------------------------
def fit_medians(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True,
                relative_error: float | None = None) -> dict[str, float]:
    cols = list(cols) if cols is not None else numeric_columns(df)
    cols = _present(df, cols)
    with held(df, *[c(x) for x in cols]) as d:
        if only_missing:
            cols = fit_missing_columns(d, cols)
        q = quantiles_of(d, cols, [0.5], relative_error=relative_error)
    return {x: q[x][0] for x in cols if q[x][0] is not None}


def fill_values(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return _replace(df, {x: F.coalesce(clean_double(c(x)), F.lit(float(v)))
                         for x, v in values.items() if x in df.columns})


# C10 -----------------------------------------------------------------------
def fit_sparse_columns(df: DataFrame, threshold: float = HIGH_MISSING_THRESHOLD,
                       cols: Sequence[str] | None = None) -> list[str]:
    cols = list(cols) if cols is not None else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for x in cols:
        v = clean_double(c(x)) if x in numeric_columns(df.select(c(x))) else c(x)
        exprs[x] = F.avg(v.isNull().cast("double"))
    res = agg_row(df, exprs)
    del fields
    return [x for x in cols if res[x] is not None and res[x] > threshold]


# C11 -----------------------------------------------------------------------
def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fill_values(df, {x: 0.0 for x in _present(df, cols)})


# C12 -----------------------------------------------------------------------
def drop_useless(df: DataFrame, dataset: str = "Global") -> DataFrame:
    drop = _present(df, ALWAYS_DROP_5G)
    if dataset != "Global":
        drop += _present(df, SLICE_ONLY_DROP_5G)
    return df.drop(*drop)


# C13 / C14 -----------------------------------------------------------------
def fit_sentinel_mode(df: DataFrame, col: str, sentinel: str = "?") -> str | None:
    return top_value(df, [col], exclude_value=sentinel)[col]


def replace_value(df: DataFrame, col: str, old: str, new: str | None) -> DataFrame:
    if new is None or col not in df.columns:
        return df
    return _replace(df, {col: F.when(c(col) == old, F.lit(new)).otherwise(c(col))})


def sentinel_to_unknown(df: DataFrame, col: str = "dDSb", sentinel: str = "?") -> DataFrame:
    return replace_value(df, col, sentinel, "unknown")


# C15 -----------------------------------------------------------------------
def dedup_exact(df: DataFrame) -> DataFrame:
    """Exact duplicate removal over all columns (partial aggregation combines hot rows map-side)."""
    return df.dropDuplicates()


# C16 -----------------------------------------------------------------------
def drop_groups(df: DataFrame, groups: Sequence[Sequence[str]] = tuple(CORR_GROUPS_5G)) -> DataFrame:
    return df.drop(*_present(df, [x for g in groups for x in g]))


# C17 / B17 -----------------------------------------------------------------
def fit_corr_matrix(df: DataFrame, cols: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """Pairwise-complete Pearson correlations of all column pairs (upper triangle).

    Two passes whatever the number of columns: the column means, and the pairwise
    moments of the centred values (counts, sums, squares and products over the rows
    where both columns have a value), as matrix products per task.  None where a side
    is constant or infinite."""
    k = len(cols)
    t = df.select(*[clean_double(c(x)).alias(f"_c{i}") for i, x in enumerate(cols)])
    finite = {i: F.when(F.abs(f"_c{i}") != float("inf"), F.col(f"_c{i}")) for i in range(k)}
    mean = agg_row(t, {i: F.avg(x) for i, x in finite.items()})
    centre = np.array([mean[i] or 0.0 for i in range(k)])

    def moments(pdf):
        x = pdf.to_numpy(dtype=float) - centre
        there, endless = ~np.isnan(x), np.isinf(x)
        x[~there | endless] = 0.0
        m, e = there.astype(float), endless.astype(float)
        return np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x, e.T @ m]).ravel()

    n, s, q, xy, endless = partition_sums(t, moments, 5 * k * k).reshape(5, k, k)
    out = {}
    for i in range(k):
        for j in range(i + 1, k):
            r = None
            if n[i, j] and not endless[i, j] and not endless[j, i]:
                vi, vj = q[i, j] - s[i, j] ** 2 / n[i, j], q[j, i] - s[j, i] ** 2 / n[i, j]
                if vi > 1e-13 * q[i, j] and vj > 1e-13 * q[j, i]:       # else constant but for rounding
                    r = float((xy[i, j] - s[i, j] * s[j, i] / n[i, j]) / math.sqrt(vi * vj))
            out[cols[i], cols[j]] = r
    return out


def greedy_correlation_drop(cols: Sequence[str], corr: dict, threshold: float = 0.90,
                            protected: Iterable[tuple[str, str]] = PROTECTED_PAIRS_6G) -> list[str]:
    """Driver-side rule over the k x k matrix: in column order, drop c when some
    earlier column has |r| > t, c is unprotected and the FIRST such partner is
    unprotected.  Not chain-aware (a partner may itself be dropped)."""
    prot = {x for pair in protected for x in pair}
    drops = []
    for j, col in enumerate(cols):
        if col in prot:
            continue
        partner = None
        for i in range(j):
            r = corr.get((cols[i], col))
            if r is not None and abs(r) > threshold:
                partner = cols[i]
                break
        if partner is not None and partner not in prot:
            drops.append(col)
    return drops


# C18 -----------------------------------------------------------------------
def asymmetry_ratio(df: DataFrame, part: str, total: str, name: str | None = None,
                    drop_part: bool = True) -> DataFrame:
    name = name or f"{part}_ratio"
    new = {name: c(part).cast("double") / (c(total).cast("double") + F.lit(1.0))}
    return _replace(df, new, [part] if drop_part else [])


# C19 -----------------------------------------------------------------------
def fit_winsor_bounds(df: DataFrame, cols: Sequence[str], lower: float = 0.01, upper: float = 0.99,
                      relative_error: float | None = None) -> dict[str, tuple[float, float]]:
    q = quantiles_of(df, _present(df, cols), [lower, upper], relative_error=relative_error)
    return {x: (v[0], v[1]) for x, v in q.items() if v[0] is not None}


def clip_expr(x: Column, lo: float, hi: float) -> Column:
    d = clean_double(x)
    return F.when(d < lo, F.lit(lo)).when(d > hi, F.lit(hi)).otherwise(d)


def winsorize(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return _replace(df, {x: clip_expr(c(x), lo, hi) for x, (lo, hi) in bounds.items()})


def winsorize_report(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Feature, n_capped, p01, p99, mean_before, mean_after; one aggregate job."""
    spark = df.sparkSession
    exprs = {}
    for x, (lo, hi) in bounds.items():
        d = clean_double(c(x))
        exprs[(x, "n")] = F.sum(((d < lo) | (d > hi)).cast("long"))
        exprs[(x, "mb")] = F.avg(d)
        exprs[(x, "ma")] = F.avg(clip_expr(c(x), lo, hi))
    res = agg_row(df, exprs)
    rows = [(x, int(res[(x, "n")] or 0), float(lo), float(hi), res[(x, "mb")], res[(x, "ma")])
            for x, (lo, hi) in bounds.items()]
    return spark.createDataFrame(
        rows, "feature string, n_capped long, p01 double, p99 double, mean_before double, mean_after double")


# C20 / C21 / C22 -----------------------------------------------------------
# Box-Cox lambda search: three stages of 21 points (step 0.2, 0.02, 0.002 around
# the previous best), lambdas held as integer thousandths so every engine
# evaluates the same points.  Each stage is one aggregation over all columns.
BOXCOX_STAGES = (200, 20, 2)
BOXCOX_POINTS = 21


def boxcox_expr(x: Column, lam: float) -> Column:
    if lam == 0:
        return F.log(x)
    return (F.pow(x, F.lit(lam)) - F.lit(1.0)) / F.lit(lam)


def boxcox_llf_expr(x: Column, lam: float) -> Column:
    """Box-Cox profile log-likelihood as an aggregate:
    llf(l) = (l - 1) * sum(ln x) - n/2 * ln(var_pop(y_l))."""
    return (F.lit(lam - 1.0) * F.sum(F.log(x))
            - F.count(x) / 2.0 * F.log(F.var_pop(boxcox_expr(x, lam))))


def boxcox_stage_points(center_k: int, step_k: int) -> list[int]:
    half = BOXCOX_POINTS // 2
    return [center_k + step_k * (j - half) for j in range(BOXCOX_POINTS)]


def fit_boxcox_lambdas(df: DataFrame, inputs: dict[str, Column]) -> dict[str, float]:
    """Maximum-likelihood lambda per input expression (values must be > 0).

    The inputs and their logarithms are projected and cached once; for each
    stage one job returns, for all columns, n, sum(ln x), sum(ln^2 x) and, per
    lambda, the power sums sum(x^l), sum(x^2l) (x^l = exp(l ln x)), from which
    var_pop(y_l) = (S2/n - (S1/n)^2) / l^2 and the profile log-likelihood follow
    on the driver."""
    names = list(inputs)
    t = df.select(*[inputs[n].alias(f"_bc{i}") for i, n in enumerate(names)])
    t = t.select(*[F.log(F.col(f"_bc{i}")).alias(f"_lx{i}") for i in range(len(names))]).persist()
    centers = {k: 0 for k in names}
    for step in BOXCOX_STAGES:
        points = [boxcox_stage_points(centers[name], step) for name in names]
        width = 3 + 2 * max(map(len, points), default=0)

        def sums(pdf, points=points, width=width):
            out = np.zeros((len(points), width))
            for i, pts in enumerate(points):
                lx = pdf.iloc[:, i].to_numpy(dtype=float)
                lx = lx[~np.isnan(lx)]
                out[i, :3] = len(lx), lx.sum(), (lx * lx).sum()
                with np.errstate(over="ignore"):
                    for j, k in enumerate(pts):
                        pw = np.exp(k / 1000.0 * lx)
                        out[i, 3 + 2 * j], out[i, 4 + 2 * j] = pw.sum(), (pw * pw).sum()
            return out.ravel()

        table = partition_sums(t, sums, len(names) * width).reshape(len(names), width)
        for name, pts, row in zip(names, points, table, strict=True):
            n, sl, sl2 = (float(v) for v in row[:3])
            best, arg = -math.inf, centers[name]
            for j, k in enumerate(pts):
                if not n:
                    break
                lam, s1, s2 = k / 1000.0, float(row[3 + 2 * j]), float(row[4 + 2 * j])
                if k == 0:
                    var = sl2 / n - (sl / n) ** 2
                else:
                    var = (s2 / n - (s1 / n) ** 2) / (lam * lam)
                if not var > 0 or math.isinf(var):
                    continue
                v = (lam - 1.0) * sl - n / 2.0 * math.log(var)
                if v > best:
                    best, arg = v, k
            centers[name] = arg
    t.unpersist()
    return {name: k / 1000.0 for name, k in centers.items()}


def boxcox_llf_table(df: DataFrame, x: Column, lambdas_k: Sequence[int]) -> DataFrame:
    """llf for the given lambdas (thousandths) as a (lambda, llf) table, one aggregation."""
    res = agg_row(df, {k: boxcox_llf_expr(x, k / 1000.0) for k in lambdas_k})
    return df.sparkSession.createDataFrame([(k / 1000.0, res[k]) for k in lambdas_k],
                                           "lambda double, llf double")


def _skews(df: DataFrame, exprs: dict[str, Column]) -> dict[str, float | None]:
    agg = {}
    for k, e in exprs.items():
        agg[(k, "g")] = F.skewness(e)
        agg[(k, "n")] = F.count(e)
        agg[(k, "sd")] = F.stddev_samp(e)
    res = agg_row(df, agg)
    out = {}
    for k in exprs:
        g, n = res[(k, "g")], res[(k, "n")]
        if g is None or n is None or n < 3 or (isinstance(g, float) and math.isnan(g)):
            out[k] = None
        else:
            out[k] = g * math.sqrt(n * (n - 1)) / (n - 2)
    return out


def log1p_clip(x: Column) -> Column:
    d = clean_double(x)
    return F.log1p(F.when(d < 0, F.lit(0.0)).otherwise(d))


def fit_log_transform(df: DataFrame, cols: Sequence[str] = LOG_FULL_5G,
                      log1p_only: Sequence[str] = LOG1P_ONLY_5G,
                      threshold: float = SKEW_THRESHOLD, boxcox: bool = True) -> list[dict]:
    """Skew-gated ``log1p(max(x,0))`` with Box-Cox fallback (notebook variant).

    Returns one plan entry per examined column: skew_before (pandas sample
    skew), skew_log, method ('none', 'log1p', 'log1p + BoxCox') and lambda.
    Five jobs: skew before, skew after log1p, and three Box-Cox stages for all columns at once.
    """
    full = _present(df, cols)
    only = _present(df, log1p_only)
    src = df
    df = df.select(*[c(x) for x in full + only]).persist()  # read by every fit job below
    before = _skews(df, {x: clean_double(c(x)) for x in full + only})
    todo = [x for x in full + only if before[x] is not None and abs(before[x]) > threshold]
    after = _skews(df, {x: log1p_clip(c(x)) for x in todo})
    plan = []
    for x in full + only:
        e = {"column": x, "skew_before": before[x], "skew_log": None, "method": "none",
             "lambda": None}
        if x in todo:
            e["skew_log"] = after[x]
            e["method"] = "log1p"
            if boxcox and x in full and after[x] is not None and abs(after[x]) > threshold:
                e["method"] = "log1p + BoxCox"
        plan.append(e)
    bc = [e for e in plan if e["method"] == "log1p + BoxCox"]
    if bc:
        lams = fit_boxcox_lambdas(df, {e["column"]: log1p_clip(c(e["column"])) + F.lit(BOXCOX_EPS_SMALL)
                                       for e in bc})
        for e in bc:
            e["lambda"] = lams[e["column"]]
    df.unpersist()
    del src
    return plan


def log_transform(df: DataFrame, plan: list[dict], suffix: str = "_log") -> DataFrame:
    new, drop = {}, []
    for e in plan:
        if e["method"] == "none":
            continue
        x = e["column"]
        y = log1p_clip(c(x))
        if e["method"] == "log1p + BoxCox":
            y = boxcox_expr(y + F.lit(BOXCOX_EPS_SMALL), e["lambda"])
        new[x + suffix] = y
        if suffix:
            drop.append(x)
    return _replace(df, new, drop)


def log1p_only(df: DataFrame, cols: Sequence[str], suffix: str = "_log",
               threshold: float = SKEW_THRESHOLD) -> DataFrame:
    plan = fit_log_transform(df, cols=[], log1p_only=cols, threshold=threshold, boxcox=False)
    return log_transform(df, plan, suffix)


# C23 / C24 / C25 / C26 -----------------------------------------------------
MAX_CATEGORIES = 4096            # values of a column that may become columns


def fit_categories(df: DataFrame, cols: Sequence[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct non-null values per column, one shuffle for all columns.

    The values become columns, so they reach the driver; a column with more than
    ``max_categories`` of them is refused (``ordinal_codes`` encodes any number)."""
    from flowlens.functions.stats import value_counts
    cols = _present(df, cols)
    out = {x: [] for x in cols}
    for r in value_counts(df, cols).select("column", "value").limit(len(cols) * max_categories + 1).collect():
        out[r["column"]].append(r["value"])
    wide = [x for x, v in out.items() if len(v) > max_categories]
    if wide:
        raise ValueError(f"too many categories to become columns: {wide}")
    return {k: sorted(v) for k, v in out.items()}


def ordinal_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Each column replaced by the 0-based rank of its value among the distinct values (missing: -1).

    The ranks are running counts over the distinct values, joined back, so a column may have
    any number of values."""
    for x in _present(df, cols):
        values = df.where(c(x).isNotNull()).select(c(x).alias("_value")).distinct().withColumn("_one", F.lit(1))
        codes = cumulative(values, "_value", ["_one"]).select("_value", (F.col("_one_cum") - 1).cast("int").alias("_code"))
        joined = df.join(codes, c(x) == F.col("_value"), "left").withColumn("_code", F.coalesce("_code", F.lit(-1)))
        df = joined.select(*[F.col("_code").alias(x) if y == x else c(y) for y in df.columns])
    return df


def onehot(df: DataFrame, categories: dict[str, list[str]], drop_first: bool = True,
           prefix: dict[str, str] | None = None) -> DataFrame:
    new, drop = {}, []
    for x, cats in categories.items():
        if x not in df.columns:
            continue
        use = cats[1:] if drop_first else cats
        pre = (prefix or {}).get(x, x)
        for v in use:
            new[f"{pre}_{v}"] = F.coalesce((c(x).cast("string") == v).cast("int"), F.lit(0))
        drop.append(x)
    return _replace(df, new, drop)


def ordinal_encode(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    new = {}
    for x, cats in categories.items():
        e = F.lit(-1)
        for i, v in reversed(list(enumerate(cats))):
            e = F.when(c(x) == v, F.lit(i)).otherwise(e)
        new[x] = e
    return _replace(df, new)


def binary_indicator(df: DataFrame, col: str = "sDSb", value: str = "cs0",
                     name: str | None = None, drop_source: bool = True) -> DataFrame:
    name = name or f"{col}_is_{value}"
    return _replace(df, {name: F.coalesce((c(col) == value).cast("int"), F.lit(0))},
                    [col] if drop_source else [])


def rename_code(df: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    for x in _present(df, cols):
        df = df.withColumnRenamed(x, x + suffix)
    return df


# C27 -----------------------------------------------------------------------
def binarize_label(df: DataFrame, col: str = "Label", mode: str = "5g") -> DataFrame:
    if mode == "5g":
        e = F.lit(None).cast("int")
        for k, v in LABEL_MAP_5G.items():
            e = F.when(c(col) == k, F.lit(v)).otherwise(e)
    else:
        e = F.when(c(col).isNull(), F.lit(None).cast("int")).otherwise(
            (F.lower(c(col)) != "benign").cast("int"))
    return _replace(df, {col: e})


# C28 -----------------------------------------------------------------------
def align_schema(df: DataFrame, reference: Sequence[str], fill=0) -> DataFrame:
    have = set(df.columns)
    return df.select(*[c(x) if x in have else F.lit(fill).alias(x) for x in reference])


# C29 / C30 -----------------------------------------------------------------
def scale_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [x for x in numeric_columns(df) if not excluded_from_scaling(x) and x not in ex]


def fit_standard_scaler(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    exprs = {}
    for x in cols:
        exprs[(x, "m")] = F.avg(clean_double(c(x)))
        exprs[(x, "s")] = F.stddev_pop(clean_double(c(x)))
    res = agg_row(df, exprs)
    out = {}
    for x in cols:
        m, s = res[(x, "m")], res[(x, "s")]
        out[x] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def standard_scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return _replace(df, {x: (clean_double(c(x)) - F.lit(m)) / F.lit(s) for x, (m, s) in params.items()})


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    exprs = {}
    for x in cols:
        exprs[(x, "lo")] = F.min(clean_double(c(x)))
        exprs[(x, "hi")] = F.max(clean_double(c(x)))
    res = agg_row(df, exprs)
    return {x: (res[(x, "lo")], res[(x, "hi")]) for x in cols}


def minmax_scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    new = {}
    for x, (lo, hi) in params.items():
        rng = (hi - lo) if (hi is not None and lo is not None and hi != lo) else 1.0
        new[x] = (clean_double(c(x)) - F.lit(lo if lo is not None else 0.0)) / F.lit(rng)
    return _replace(df, new)


# C31 -----------------------------------------------------------------------
def prefer_log(df: DataFrame, suffix: str = "_log") -> DataFrame:
    have = set(df.columns)
    return df.drop(*[x for x in df.columns if x + suffix in have])


# C34 / C35 -----------------------------------------------------------------
def sanitize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    new = {}
    for x in _present(df, cols):
        d = c(x).cast("double")
        new[x] = F.when(d.isNull() | F.isnan(d) | (F.abs(d) == float("inf")), F.lit(0.0)).otherwise(d)
    return _replace(df, new)


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _replace(df, {x: F.expr(f"try_cast(`{x}` AS DOUBLE)") for x in _present(df, cols)})


def sample_skew(col: Column) -> Column:
    return sample_skew_from_pop(F.skewness(col), F.count(col).cast("double"))
