"""Cleaning pipelines composed from the fit / transform operators.

Each step fits on the output of the previous step (one aggregate job per
data-dependent step) and transforms lazily; the input is persisted once so
the fits re-read it from memory.  The fitted parameters are returned with the
table so the same pipeline can be replayed on new data.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.stats import c, numeric_columns
from flowlens.operators import clean as C
from flowlens.session import persist_dealt, persist_input, swap_input


def _eligible(df: DataFrame, exclude_label: str = "Label") -> list[str]:
    return [x for x in numeric_columns(df) if not C.excluded_from_scaling(x) and x != exclude_label]


def _non_constant(df: DataFrame, cols) -> list[str]:
    const = set(C.fit_constant_columns(df, cols))
    return [x for x in cols if x not in const]


def pipeline_6g(df: DataFrame, port_top_n: int | None = C.TOP_N_PORTS, corr_threshold: float = 0.90,
                label: str = "Label") -> tuple[DataFrame, dict]:
    """N1-N10 in documented order: N1 drop NULL labels; N2 destination-port one-hot
    (top-N, or the fixed list when ``port_top_n`` is None) and identifier drop; N3
    constant columns; N4 protocol one-hot; N5 rate indicators (only if missing) and
    median imputation; N6 exact duplicates; N7 greedy correlation drop; N8 P1-P99
    caps; N9 skew-gated log1p with Box-Cox fallback (in place); N10 scaling."""
    p: dict = {}
    d = persist_input(C.drop_null_label(df, label))                                   # N1
    if "Destination Port" in d.columns:                                                # N2
        if port_top_n:
            p["ports"] = C.fit_top_ports(d, "Destination Port", port_top_n)
            d = C.port_onehot_topn(d, p["ports"], "Destination Port")
        else:
            d = C.port_onehot_fixed(d, "Destination Port", drop_source=True)
    d = C.drop_identifiers(d)
    p["constant"] = C.fit_constant_columns(d, [x for x in numeric_columns(d) if x != label])   # N3
    d = C.drop_columns(d, p["constant"])
    if "Protocol" in d.columns:                                                        # N4
        p["protocols"] = C.fit_protocol_categories(d, "Protocol")
        d = C.protocol_onehot(d, p["protocols"], "Protocol")
    d = C.inf_to_null(d, C.RATE_DERIVED_6G)                                            # N5
    p["indicators"] = C.fit_missing_columns(d, C.RATE_DERIVED_6G)
    d = C.missing_indicator(d, p["indicators"])
    p["medians"] = C.fit_medians(d, [x for x in numeric_columns(d) if x != label])
    d = persist_input(C.fill_values(d, p["medians"]))
    d = persist_input(C.dedup_exact(d))                                                # N6
    feats = [x for x in d.columns if x != label and x in numeric_columns(d)]           # N7
    corr = C.fit_corr_matrix(d, feats)
    p["corr_drop"] = C.greedy_correlation_drop(feats, corr, corr_threshold)
    d = C.drop_columns(d, p["corr_drop"])
    cap = _non_constant(d, [x for x in numeric_columns(d) if x != label and not (   # N8
        x.startswith(("Proto_", "Port_")) or "Flag Count" in x)])
    p["caps"] = C.fit_winsor_bounds(d, cap)
    d = persist_input(C.winsorize(d, p["caps"]))
    logc = _non_constant(d, _eligible(d, label))                                       # N9
    p["log_plan"] = C.fit_log_transform(d, logc, [])
    d = persist_input(C.log_transform(d, p["log_plan"], suffix=""))
    scale = C.scale_columns(d)                                                         # N10
    p["scaler"] = C.fit_standard_scaler(d, scale)
    return C.standard_scale(d, p["scaler"]), p


def pipeline_5g(df: DataFrame, dataset: str = "Global", label: str = "Label", stored: bool = False) -> tuple[DataFrame, dict]:
    """Steps 2-8 of the notebook variant for one dataset: useless columns; missingness
    (indicators, > 75 % drop, medians, zero sentinels); '?' sentinels; correlated
    groups and the loss ratio; P1-P99 caps; skew-gated log with ``_log`` names and
    Box-Cox fallback; one-hot (first dropped), sDSb indicator, ``_code`` renames,
    slice one-hot and the 0/1 label.  A cached step is released when the next one is cached; the
    input is not cached if it is ``stored``."""
    p: dict = {}
    d = C.drop_useless(df, dataset)                                                    # step 2
    if not stored:
        d = persist_input(d)
    held = None if stored else d
    p["indicators"] = C.fit_missing_columns(d, C.INFORMATIVE_MISSING_5G)               # step 3
    d = C.missing_indicator(d, p["indicators"])
    p["sparse"] = C.fit_sparse_columns(d, C.HIGH_MISSING_THRESHOLD,
                                       [x for x in C.MEDIAN_IMPUTE_5G + C.ZERO_SENTINEL_5G if x in d.columns])
    d = C.drop_columns(d, p["sparse"])
    p["medians"] = C.fit_medians(d, [x for x in C.MEDIAN_IMPUTE_5G if x in d.columns])
    d = C.impute_zero(C.fill_values(d, p["medians"]), C.ZERO_SENTINEL_5G)
    if "sDSb" in d.columns:                                                            # step 4
        p["sDSb_mode"] = C.fit_sentinel_mode(d, "sDSb")
        d = C.replace_value(d, "sDSb", "?", p["sDSb_mode"])
    d = held = swap_input(held, C.sentinel_to_unknown(d, "dDSb"))
    d = C.drop_groups(d, C.CORR_GROUPS_5G)                                             # step 5
    if "SrcLoss" in d.columns and "Loss" in d.columns:
        d = C.asymmetry_ratio(d, "SrcLoss", "Loss", "SrcLoss_ratio")
    p["caps"] = C.fit_winsor_bounds(d, [x for x in C.CAP_COLUMNS_5G if x in d.columns])  # step 6
    d = swap_input(held, C.winsorize(d, p["caps"]))
    p["log_plan"] = C.fit_log_transform(d, C.LOG_FULL_5G, C.LOG1P_ONLY_5G)            # step 7
    d = C.log_transform(d, p["log_plan"])
    p["categories"] = C.fit_categories(d, [x for x in C.ONEHOT_5G if x in d.columns])  # step 8
    d = C.onehot(d, p["categories"], drop_first=True)
    if "sDSb" in d.columns:
        d = C.binary_indicator(d, "sDSb", "cs0")
    d = C.rename_code(d, ["sTos", "dTos"])
    if "predicted" in d.columns:
        p["slices"] = C.fit_categories(d, ["predicted"])
        d = C.onehot(d, p["slices"], drop_first=True, prefix={"predicted": "slice"})
    return C.binarize_label(d, label, "5g"), p


# fixed values: the datasets of the 5G family and the slice that each holds
FAMILY_5G = {"Global": None, "eMBB": "1:eMBB", "mMTC": "2:mMTC", "URLLC": "3:URLLC"}


def pipeline_5g_family(df: DataFrame, slice_col: str = "predicted", datasets: dict | None = None,
                       label: str = "Label") -> tuple[DataFrame, dict]:
    """Steps 1-9: the pipeline for every dataset of the family with parameters of its own, aligned to the
    cleaned Global table (its column order; a column that a dataset lacks is 0, others go) and stacked
    under ``dataset``.  Returns the table and the parameters by dataset.

    The datasets are filters of one stored table and their fits are independent, so they are
    submitted together.  A dataset without rows contributes none.
    """
    stored = persist_dealt(df)
    wanted = datasets or FAMILY_5G

    def clean(name):
        part = stored if wanted[name] is None else stored.where(c(slice_col) == wanted[name])
        return pipeline_5g(part, name, label, stored=True)

    with ThreadPoolExecutor(max_workers=len(wanted)) as pool:
        cleaned = dict(zip(wanted, pool.map(clean, wanted), strict=True))
    stored.unpersist()                                        # every dataset's last step is cached
    reference = next(iter(cleaned.values()))[0]
    types = dict(reference.dtypes)
    out = None
    for name, (table, _) in cleaned.items():                                           # step 9
        table = C.align_schema(table, reference.columns)
        table = table.select(F.lit(name).alias("dataset"), *[c(x).cast(types[x]).alias(x) for x in reference.columns])
        out = table if out is None else out.unionByName(table)
    return out, {name: p for name, (_, p) in cleaned.items()}
