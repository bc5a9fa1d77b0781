"""Catalogue: splits, partitions and labelled augmentation."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from flowlens.functions.exprs import HASH_MULT, HASH_MULT_2, hash32_sql, sig as ssig, uniform_sql
from flowlens.operators import clean as C
from flowlens.operators import project as P
from flowlens.operators import split as E
from flowlens.plans.q_project import P6_SQL, cic_flows, clean_6g_rates
from flowlens.plans.registry import query
from flowlens.plans.sqlkit import sig
from flowlens.plans.views import view
from flowlens.session import persist_input

F5 = ("flows_5g",)
F6 = ("flows_6g",)
TIE5 = ["Seq", "Dur", "TotPkts", "SrcPkts", "TotBytes", "SrcBytes", "sMeanPktSz", "dMeanPktSz", "Load", "Rate",
        "Loss", "dTtl", "sVid", "Proto", "State", "sDSb", "dDSb", "predicted"]
LAB5 = "(SELECT * REPLACE (CASE Label WHEN 'Benign' THEN 0 WHEN 'Malicious' THEN 1 END AS Label) FROM flows_5g)"


def _order5():
    return f"{hash32_sql('UniqueID')}, UniqueID, " + ", ".join(f"{x} ASC NULLS FIRST" for x in TIE5)


def _cut_sql(n, pct):
    return f"floor(({n} * {pct} + 50) / 100)"


def v5l(spark, sf):
    return C.binarize_label(view(spark, sf, "flows_5g"), "Label", "5g")


@query("split_stratified", f"""
SELECT UniqueID, Label, CASE WHEN row_number() OVER (PARTITION BY Label ORDER BY {_order5()})
 <= {_cut_sql('count(*) OVER (PARTITION BY Label)', 80)} THEN 'train' ELSE 'test' END AS split FROM {LAB5}""", F5)
def q_split_stratified(spark, sf):
    """Stratified 80/20 split by hash order within each class."""
    return E.split_stratified(persist_input(v5l(spark, sf)), "UniqueID", "Label", 20).select("UniqueID", "Label", "split")


@query("split_three_way", f"""
WITH r AS (SELECT UniqueID, Label, row_number() OVER (PARTITION BY Label ORDER BY {_order5()}) AS rk,
  count(*) OVER (PARTITION BY Label) AS n FROM {LAB5})
SELECT UniqueID, Label, CASE WHEN rk <= {_cut_sql('n', 70)} THEN 'train' WHEN rk <= {_cut_sql('n', 85)} THEN 'val'
 ELSE 'test' END AS split FROM r""", F5)
def q_split_three_way(spark, sf):
    """Stratified 70/15/15 three-way split."""
    return E.split_three_way(persist_input(v5l(spark, sf)), "UniqueID", "Label", (70, 15, 15)).select("UniqueID", "Label", "split")


@query("slice_partition", """
SELECT UniqueID, CASE predicted WHEN '2:mMTC' THEN 'mMTC' WHEN '3:URLLC' THEN 'URLLC' ELSE 'eMBB' END AS slice FROM flows_5g""", F5)
def q_slice_partition(spark, sf):
    """Slice column from the slice one-hots (eMBB = neither indicator)."""
    df = view(spark, sf, "flows_5g").select("UniqueID", "predicted")
    oh = C.onehot(df, C.fit_categories(df, ["predicted"]), drop_first=True, prefix={"predicted": "slice"})
    return E.slice_partition(oh).select("UniqueID", "slice")


@query("proto_partition", "SELECT flow_id, CASE WHEN protocol = 6 THEN 'TCP' ELSE 'UDP' END AS proto FROM flows_6g", F6)
def q_proto_partition(spark, sf):
    """TCP / UDP (= not TCP) partition from the protocol one-hot."""
    df = cic_flows(spark, sf)
    oh = C.protocol_onehot(df, C.fit_protocol_categories(df, "Protocol"), "Protocol")
    return E.proto_partition(oh, "Proto_TCP").select(F.col("`Flow ID`").alias("flow_id"), "proto")


@query("kfold", f"""
SELECT UniqueID, Label, CAST((row_number() OVER (PARTITION BY Label ORDER BY {_order5()}) - 1) % 5 AS INT) AS fold FROM {LAB5}""", F5)
def q_kfold(spark, sf):
    """E5: stratified 5-fold assignment."""
    return E.kfold(v5l(spark, sf), "UniqueID", "Label", 5).select("UniqueID", "Label", "fold")


@query("class_weights", """
WITH g AS (SELECT Label AS label, count(*) AS n_c FROM (SELECT CASE Label WHEN 'Benign' THEN 0 WHEN 'Malicious' THEN 1 END AS Label FROM flows_5g) GROUP BY Label),
t AS (SELECT sum(n_c) AS n, sum(CASE WHEN label = 0 THEN n_c END) AS neg, sum(CASE WHEN label = 1 THEN n_c END) AS pos FROM g)
SELECT label, n_c, n / (2.0 * n_c) AS weight, CAST(neg AS DOUBLE) / pos AS imbalance_ratio FROM g, t""", F5)
def q_class_weights(spark, sf):
    """Balanced class weights n / (2 n_c) and the neg / pos ratio."""
    return E.class_weights(v5l(spark, sf), "Label")


TIE6 = ["src", "ts", "dst_port", "protocol", "flow_duration", "fwd_pkts", "bwd_pkts", "fwd_len_mean", "bwd_len_mean",
        "flow_bytes_s", "flow_packets_s", "syn", "fin", "rst", "psh", "urg", "Label"]


@query("shuffle", f"""
SELECT flow_id, row_number() OVER (ORDER BY {hash32_sql('flow_id')}, flow_id, {', '.join(x + ' ASC NULLS FIRST' for x in TIE6)}) AS "order" FROM flows_6g""", F6)
def q_shuffle(spark, sf):
    """Deterministic shuffle order (rank by id hash)."""
    return E.shuffle_rank(view(spark, sf, "flows_6g"), "flow_id").select("flow_id", "order")


def projected_labelled_6g(spark, sf):
    df = C.binarize_label(clean_6g_rates(cic_flows(spark, sf)), "Label", "6g")
    p = P.project_6g(df, keep=["Flow ID", "Label"])
    return p.withColumnRenamed("Flow ID", "flow_id")


PROJ6_SQL = "(" + P6_SQL.replace("flow_id,", "flow_id, CAST(lower(Label) <> 'benign' AS INT) AS Label,", 1) + ")"
PTIE = ["Label", "u_duration", "u_fwd_pkts", "u_bwd_pkts", "u_fwd_mean_size", "u_bwd_mean_size", "u_byte_rate",
        "u_pkt_rate", "u_pkt_ratio", "u_size_ratio", "u_syn", "u_fin", "u_rst", "u_psh", "u_is_tcp", "u_is_udp",
        "u_is_other"]


def _select_sql(frac=0.15, seed=42):
    prof = f"CAST(({hash32_sql('flow_id', seed + E.PROFILE_STREAM)}) % 4 AS INT)"
    # flow_id is unique in the stand-in, so the hash order needs no further tie-break
    return (f"(SELECT *, CAST(rk <= floor({frac} * n) AS INT) AS injected, CASE WHEN rk <= floor({frac} * n) THEN {prof} END AS profile"
            f" FROM (SELECT *, row_number() OVER (ORDER BY {hash32_sql('flow_id', seed + E.CHOICE_STREAM)}, flow_id) AS rk, count(*) OVER () AS n FROM {PROJ6_SQL}))")


@query("inject_select", f"SELECT flow_id, injected, profile FROM {_select_sql()}", F6)
def q_inject_select(spark, sf):
    """Choose floor(0.15 n) rows by hash rank and assign one of the 4 attack profiles."""
    return E.inject_select(projected_labelled_6g(spark, sf), "flow_id", 0.15).select("flow_id", "injected", "profile")


def _gauss_sql(seed, j):
    u1 = uniform_sql("flow_id", seed + E.NOISE_STREAM + j, HASH_MULT)
    u2 = uniform_sql("flow_id", seed + E.NOISE_STREAM + j, HASH_MULT_2)
    return f"(sqrt(-2.0 * ln({u1})) * cos({repr(2 * math.pi)} * {u2}))"


NOISE_FEATS = P.UNIFIED_FEATURES


def _noise_sql(seed=42):
    names = list(E.ATTACK_PROFILES)
    cols = []
    for j, f in enumerate(NOISE_FEATS):
        e = "CAST(0.0 AS DOUBLE)"
        for p, name in enumerate(names):
            prof = E.ATTACK_PROFILES[name]
            if f in prof["features"]:
                e = f"CASE WHEN profile = {p} THEN {_gauss_sql(seed, j + 1)} * {prof['multiplier']} ELSE {e} END"
        cols.append(sig(f"CASE WHEN injected = 1 THEN {f} + {e} ELSE {f} END", 8) + f" AS {f}")
    return ("SELECT flow_id, " + ", ".join(cols) + ", CASE WHEN injected = 1 THEN 1 ELSE Label END AS Label FROM "
            + _select_sql())


@query("inject_noise", _noise_sql(), F6)
def q_inject_noise(spark, sf):
    """Add N(0, profile multiplier) (Box-Muller from id hashes) to the chosen rows' profile
    features and label them 1."""
    df = projected_labelled_6g(spark, sf).select("flow_id", "Label", *NOISE_FEATS)
    out = E.inject_noise(df, "flow_id", "Label", NOISE_FEATS, 0.15)
    return out.select("flow_id", *[ssig(F.col(f), 8).alias(f) for f in NOISE_FEATS], "Label")


STRUCT_COLS = ["Flow Duration", "Total Fwd Packets", "Flow Bytes/s", "Flow Packets/s", "SYN Flag Count"]
STRUCT_SRC = {"Flow Duration": "flow_duration", "Total Fwd Packets": "fwd_pkts", "Flow Bytes/s": "fb",
              "Flow Packets/s": "fp", "SYN Flag Count": "syn"}


def _struct_sql(seed=42):
    base = ("(SELECT flow_id, flow_duration, fwd_pkts, syn, "
            "coalesce(CASE WHEN isnan(flow_bytes_s) OR abs(flow_bytes_s) = 'Infinity'::DOUBLE THEN NULL ELSE flow_bytes_s END, 0.0) AS fb, "
            "coalesce(CASE WHEN isnan(flow_packets_s) OR abs(flow_packets_s) = 'Infinity'::DOUBLE THEN NULL ELSE flow_packets_s END, 0.0) AS fp "
            "FROM flows_6g WHERE Label IS NOT NULL AND lower(Label) = 'benign')")
    ranked = f"(SELECT *, row_number() OVER (ORDER BY {hash32_sql('flow_id', seed)}, flow_id) AS rk, count(*) OVER () AS n FROM {base})"
    syn = [x for x in STRUCT_COLS if "SYN" in x.upper()]
    dur = [x for x in STRUCT_COLS if "Duration" in x or "IAT" in x]
    byt = [x for x in STRUCT_COLS if "Bytes" in x or "Packets" in x]

    def variant(name, k, cond, targets, op, lo, hi):
        cols = []
        for x in STRUCT_COLS:
            src = f"CAST({STRUCT_SRC[x]} AS DOUBLE)"
            if x in targets:
                j = targets.index(x)
                u = f"({lo} + {hi - lo} * {uniform_sql('flow_id', seed + E.UNIFORM_STREAM * k + j)})"
                src = f"{src} + {u}" if op == "add" else f"{src} * {u}"
            cols.append(sig(src, 8) + f' AS "{x}"')
        return f"SELECT flow_id, {', '.join(cols)}, 1 AS Label, '{name}' AS variant FROM r WHERE {cond}"

    ben = ("SELECT flow_id, " + ", ".join(sig(f"CAST({STRUCT_SRC[x]} AS DOUBLE)", 8) + f' AS "{x}"' for x in STRUCT_COLS)
           + ", 0 AS Label, 'benign' AS variant FROM r")
    parts = [ben, variant("syn_flood", 1, "rk <= floor(n / 3)", syn, "add", *E.SYN_FLOOD_ADD),
             variant("port_scan", 2, "rk <= floor(n / 3)", dur, "mul", *E.PORT_SCAN_MUL),
             variant("ddos", 3, "rk <= n - 2 * floor(n / 3)", byt, "add", *E.DDOS_ADD)]
    return f"WITH r AS {ranked}\n" + "\nUNION ALL ".join(parts)


@query("inject_structured", _struct_sql(), F6)
def q_inject_structured(spark, sf):
    """Benign rows plus SYN-flood / port-scan / DDoS perturbed copies (thirds), labelled 1."""
    df = C.binarize_label(clean_6g_rates(cic_flows(spark, sf)), "Label", "6g")
    df = df.where("Label = 0").select(F.col("`Flow ID`").alias("flow_id"),
                                      *[F.col(f"`{x}`").cast("double").alias(x) for x in STRUCT_COLS], "Label")
    out = E.inject_structured(df, "flow_id", "Label")
    return out.select("flow_id", *[ssig(F.col(f"`{x}`"), 8).alias(x) for x in STRUCT_COLS], "Label", "variant")
