"""Catalogue: unified projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.exprs import sig as ssig
from flowlens.operators import clean as C
from flowlens.operators import project as P
from flowlens.plans.registry import query
from flowlens.plans.sqlkit import sig
from flowlens.plans.views import CIC_NAMES, view


def cic_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flows_6g with CICFlowMeter column names (input adapter only)."""
    df = view(spark, sf_dir, "flows_6g")
    return df.select(*[F.col(k).alias(CIC_NAMES.get(k, k)) for k in df.columns])


def clean_6g_rates(df: DataFrame) -> DataFrame:
    """N1 + rate-derived missingness (src variant: indicator always, fill 0)."""
    df = C.drop_null_label(df)
    df = C.inf_to_null(df, C.RATE_DERIVED_6G)
    return C.missing_indicator(df, C.RATE_DERIVED_6G, fill=0.0)


def projected_6g(spark, sf_dir) -> DataFrame:
    df = clean_6g_rates(cic_flows(spark, sf_dir))
    return P.project_6g(df, keep=["Flow ID"]).withColumnRenamed("Flow ID", "flow_id")


def onehot_5g(spark, sf_dir) -> DataFrame:
    """flows_5g with Proto / State one-hot (first category dropped), as cleaned 5G has."""
    df = view(spark, sf_dir, "flows_5g")
    cats = C.fit_categories(df, ["Proto", "State"])
    return C.onehot(df, cats, drop_first=True)


def projected_5g(spark, sf_dir) -> DataFrame:
    return P.project_5g(onehot_5g(spark, sf_dir), keep=["UniqueID"])


def _round(df: DataFrame, cols, n=9) -> DataFrame:
    return df.select(*[F.round(F.col(x), n).alias(x) if x in cols else F.col(x) for x in df.columns])


RATE_SQL = "coalesce(CASE WHEN isnan({c}) OR abs({c}) = 'Infinity'::DOUBLE THEN NULL ELSE {c} END, 0.0)"

P6_SQL = f"""
SELECT flow_id, flow_duration AS u_duration, fwd_pkts AS u_fwd_pkts, bwd_pkts AS u_bwd_pkts,
 fwd_len_mean AS u_fwd_mean_size, bwd_len_mean AS u_bwd_mean_size,
 {RATE_SQL.format(c='flow_bytes_s')} AS u_byte_rate, {RATE_SQL.format(c='flow_packets_s')} AS u_pkt_rate,
 (abs(fwd_pkts)+1e-6)/((abs(fwd_pkts)+1e-6)+(abs(bwd_pkts)+1e-6)) AS u_pkt_ratio,
 (abs(fwd_len_mean)+1e-6)/((abs(fwd_len_mean)+1e-6)+(abs(bwd_len_mean)+1e-6)) AS u_size_ratio,
 CAST(syn>0 AS INT) AS u_syn, CAST(fin>0 AS INT) AS u_fin, CAST(rst>0 AS INT) AS u_rst, CAST(psh>0 AS INT) AS u_psh,
 CAST(protocol=6 AS INT) AS u_is_tcp, CAST(protocol=17 AS INT) AS u_is_udp,
 CAST(protocol<>6 AND protocol<>17 AS INT) AS u_is_other
FROM flows_6g WHERE Label IS NOT NULL"""


@query("project_6g", P6_SQL, ("flows_6g",))
def q_project_6g(spark, sf_dir):
    """N1 + rate indicators + D6 projection of the CIC flows."""
    return projected_6g(spark, sf_dir)


P5_SQL = """
SELECT UniqueID, round(Dur, 9) AS u_duration, round(SrcPkts, 9) AS u_fwd_pkts,
 round(ln(1 + CASE WHEN TotPkts - SrcPkts >= 0 THEN TotPkts - SrcPkts ELSE 0.0 END), 9) AS u_bwd_pkts,
 round(sMeanPktSz, 9) AS u_fwd_mean_size, round(dMeanPktSz, 9) AS u_bwd_mean_size,
 round(Load, 9) AS u_byte_rate, round(Rate, 9) AS u_pkt_rate,
 round((abs(SrcPkts)+1e-6)/((abs(SrcPkts)+1e-6)+(abs(ln(1 + CASE WHEN TotPkts - SrcPkts >= 0 THEN TotPkts - SrcPkts ELSE 0.0 END))+1e-6)), 9) AS u_pkt_ratio,
 round((abs(sMeanPktSz)+1e-6)/((abs(sMeanPktSz)+1e-6)+(abs(dMeanPktSz)+1e-6)), 9) AS u_size_ratio,
 0 AS u_syn, CAST(State='FIN' AS INT) AS u_fin, CAST(State='RST' AS INT) AS u_rst, 0 AS u_psh,
 CAST(Proto='tcp' AS INT) AS u_is_tcp, CAST(Proto='udp' AS INT) AS u_is_udp,
 CAST(Proto NOT IN ('tcp','udp') AS INT) AS u_is_other
FROM flows_5g"""


@query("project_5g", P5_SQL, ("flows_5g",))
def q_project_5g(spark, sf_dir):
    """Proto/State one-hot (drop first) + D5 projection; bwd packets rebuilt from tot - fwd."""
    df = projected_5g(spark, sf_dir)
    return _round(df, P.NUMERIC_FEATURES)


@query("flags_5g", """
SELECT State, 0 AS u_syn, CAST(State='FIN' AS INT) AS u_fin, CAST(State='RST' AS INT) AS u_rst, 0 AS u_psh,
 CAST(count(*) AS BIGINT) AS n FROM flows_5g GROUP BY ALL""", ("flows_5g",))
def q_flags_5g(spark, sf_dir):
    """SYN/FIN/RST/PSH indicators from State_* one-hots, counted per raw State."""
    df = view(spark, sf_dir, "flows_5g")
    cats = C.fit_categories(df, ["State"])
    oh = C.onehot(df.withColumn("raw_state", F.col("State")), cats, drop_first=True)
    flags = P.flags_5g(oh)
    return (oh.select(F.col("raw_state").alias("State"), *[e.alias(k) for k, e in flags.items()])
            .groupBy("State", "u_syn", "u_fin", "u_rst", "u_psh").agg(F.count(F.lit(1)).alias("n")))


@query("bwd_pkts", """
SELECT UniqueID, round(ln(1 + CASE WHEN (exp(ln(1+TotPkts))-1) - (exp(ln(1+SrcPkts))-1) >= 0
   THEN (exp(ln(1+TotPkts))-1) - (exp(ln(1+SrcPkts))-1) ELSE 0.0 END), 6) AS u_bwd_pkts
FROM flows_5g""", ("flows_5g",))
def q_bwd_pkts(spark, sf_dir):
    """D7 on log-space inputs: TotPkts_log/SrcPkts_log -> expm1 -> diff -> clip -> log1p."""
    df = view(spark, sf_dir, "flows_5g").select(
        "UniqueID", F.log1p("TotPkts").alias("TotPkts_log"), F.log1p("SrcPkts").alias("SrcPkts_log"))
    return df.select("UniqueID", F.round(P.bwd_pkts_expr(df.columns), 6).alias("u_bwd_pkts"))


@query("ratios", """
SELECT flow_id, (abs(fwd_pkts)+1e-6)/((abs(fwd_pkts)+1e-6)+(abs(bwd_pkts)+1e-6)) AS u_pkt_ratio,
 (abs(fwd_len_mean)+1e-6)/((abs(fwd_len_mean)+1e-6)+(abs(bwd_len_mean)+1e-6)) AS u_size_ratio
FROM flows_6g""", ("flows_6g",))
def q_ratios(spark, sf_dir):
    """D8 directional ratios with epsilon guard."""
    df = view(spark, sf_dir, "flows_6g")
    return df.select("flow_id", P.ratio(F.col("fwd_pkts"), F.col("bwd_pkts")).alias("u_pkt_ratio"),
                     P.ratio(F.col("fwd_len_mean"), F.col("bwd_len_mean")).alias("u_size_ratio"))


@query("proto_onehot", """
SELECT Proto, CAST(Proto='tcp' AS INT) AS u_is_tcp, CAST(Proto='udp' AS INT) AS u_is_udp,
 CAST(Proto NOT IN ('tcp','udp') AS INT) AS u_is_other, CAST(count(*) AS BIGINT) AS n
FROM flows_5g GROUP BY ALL""", ("flows_5g",))
def q_proto_onehot(spark, sf_dir):
    """Protocol flags from Proto_* one-hots (first dropped -> none set -> other)."""
    df = view(spark, sf_dir, "flows_5g")
    cats = C.fit_categories(df, ["Proto"])
    oh = C.onehot(df.withColumn("raw_proto", F.col("Proto")), cats, drop_first=True)
    e = P.proto_onehot_exprs(oh.columns)
    return (oh.select(F.col("raw_proto").alias("Proto"), *[v.alias(k) for k, v in e.items()])
            .groupBy("Proto", "u_is_tcp", "u_is_udp", "u_is_other").agg(F.count(F.lit(1)).alias("n")))


FEATURE_LIST = ", ".join(P.UNIFIED_FEATURES)
UNION_ROWS = f"""u AS (SELECT 'g5' AS domain, {FEATURE_LIST} FROM ({P5_SQL})
 UNION ALL SELECT 'g6', {FEATURE_LIST} FROM ({P6_SQL}))"""


@query("unified_union", f"""WITH {UNION_ROWS}
SELECT domain, CAST(count(*) AS BIGINT) AS n, {', '.join(f"{sig(f'avg({f})', 6)} AS {f}" for f in P.UNIFIED_FEATURES)}
FROM u GROUP BY domain""", ("flows_5g", "flows_6g"))
def q_unified_union(spark, sf_dir):
    """Stack both projected generations with a domain column; rows and the mean of every feature per domain."""
    u = P.unified_union({"g5": projected_5g(spark, sf_dir), "g6": projected_6g(spark, sf_dir)})
    return u.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *[ssig(F.avg(f), 6).alias(f) for f in P.UNIFIED_FEATURES])


def unified_scaled(spark, sf_dir):
    """Union of both projections with the 9 numeric features standard-scaled (fit on the union)."""
    u = P.unified_union({"g5": projected_5g(spark, sf_dir).withColumnRenamed("UniqueID", "id"),
                         "g6": projected_6g(spark, sf_dir).withColumnRenamed("flow_id", "id")})
    u = C.sanitize(u, P.NUMERIC_FEATURES)
    params = C.fit_standard_scaler(u, P.NUMERIC_FEATURES)
    return C.standard_scale(u, params), params


@query("unified_scale", f"""WITH {UNION_ROWS},
v AS (SELECT domain, {', '.join(f"coalesce({f}, 0.0) AS {f}" for f in P.NUMERIC_FEATURES)} FROM u),
s AS (SELECT {', '.join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in P.NUMERIC_FEATURES)} FROM v)
SELECT domain, CAST(count(*) AS BIGINT) AS n,
 {', '.join(f"round(avg(({f} - m_{f}) / s_{f}), 6) AS mean_{f}, round(max(({f} - m_{f}) / s_{f}), 6) AS max_{f}" for f in P.NUMERIC_FEATURES)}
FROM v, s GROUP BY domain""", ("flows_5g", "flows_6g"))
def q_unified_scale(spark, sf_dir):
    """Scaler on the 9 numeric unified features fit on the union; mean and maximum of each per domain."""
    df, _ = unified_scaled(spark, sf_dir)
    return df.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *[
        e for f in P.NUMERIC_FEATURES for e in (F.round(F.avg(f), 6).alias(f"mean_{f}"), F.round(F.max(f), 6).alias(f"max_{f}"))])


@query("detect_schema", f"SELECT 'cic' AS schema_name, * FROM ({P6_SQL})", ("flows_6g",))
def q_detect_schema(spark, sf):
    """The format found from the columns of the flow table, which is then validated and projected."""
    name, out = P.project_auto(clean_6g_rates(cic_flows(spark, sf)), keep=["Flow ID"])
    return out.select(F.col("`Flow ID`").alias("flow_id"), F.lit(name).alias("schema_name"), *P.UNIFIED_FEATURES)
