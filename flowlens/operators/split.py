"""Splits, partitions and labelled augmentation.

Row choice is deterministic and independent of partitioning: rows are
ordered by a portable integer hash of their id (ties by id).  Cuts into first
and other rows are found by counting hash prefixes (:func:`first_of_rank`), so
rows are not moved; full ranks (folds, shuffles) come from the distributed
running count (:func:`~flowlens.functions.stats.cumulative`), never from a
window over a whole label.  Cut points use integer arithmetic, so every engine agrees.
Random draws (noise, uniforms) are pure functions of (id, seed, column).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.exprs import HASH_MULT, HASH_MULT_2, hash32, uniform
from flowlens.functions.stats import c, cumulative

# ---- fixed values ----------------------------------------------------------
ATTACK_PROFILES = {
    "SYN Flood": {"features": ["u_syn", "u_pkt_rate", "u_duration"], "multiplier": 8.0},
    "Port Scan": {"features": ["u_rst", "u_duration", "u_pkt_ratio"], "multiplier": 6.0},
    "DDoS Volume": {"features": ["u_byte_rate", "u_pkt_rate", "u_fwd_pkts"], "multiplier": 10.0},
    "Data Exfiltration": {"features": ["u_bwd_mean_size", "u_byte_rate"], "multiplier": 5.0},
}
ANOMALY_FRACTION = 0.15
SYN_FLOOD_ADD = (3.0, 8.0)
PORT_SCAN_MUL = (0.01, 0.1)
DDOS_ADD = (4.0, 10.0)
# Hash streams by purpose: offsets added to the caller's seed.
CHOICE_STREAM, PROFILE_STREAM, NOISE_STREAM, UNIFORM_STREAM = 1_000, 2_000, 3_000, 10_000
# ---------------------------------------------------------------------------


def _orderable(df: DataFrame, exclude) -> list[str]:
    bad = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    return [f.name for f in df.schema.fields if f.name not in exclude and not isinstance(f.dataType, bad)]


def hash_rank(df: DataFrame, id_col: str, label: str | None = None, seed: int = 42,
              out: str = "rank") -> DataFrame:
    """1-based rank by (hash(id), id, remaining columns), within ``label`` if given;
    adds ``n_label``.  Ties remain only between fully identical rows, which are
    interchangeable, so the result does not depend on partitioning."""
    keys = [label] if label else []
    tie = _orderable(df, {id_col, *keys})
    d = df.withColumn("_h", hash32(c(id_col), seed)).withColumn("_one", F.lit(1))
    d = d.withColumn("_id", c(id_col))
    r = cumulative(d, ["_h", "_id", *tie], ["_one"], key_cols=keys).withColumnRenamed("_one_cum", out)
    tot = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_label"))  # one row per label
    if keys:
        tot = tot.withColumnRenamed(label, "_lab")
        r = r.join(F.broadcast(tot), c(label).eqNullSafe(F.col("_lab"))).drop("_lab")
    else:
        r = r.crossJoin(tot)
    return r.drop("_h", "_one", "_id")


PREFIX_BITS = 12                 # hash prefixes whose counts find the bucket of a cut


def first_of_rank(df: DataFrame, id_col: str, label: str | None, seed: int, targets: Sequence[Callable[[int], int]]) -> DataFrame:
    """``df`` with a boolean column ``_first<i>`` per target: whether the row is among the first
    ``targets[i](rows of its label)`` in the order of :func:`hash_rank`.

    No row moves: counts per hash prefix (one aggregate, at most 4,096 rows a label) find the
    bucket in which each cut lies, only the rows of these buckets are ordered, and the
    cut is a comparison with the one key found there.  Where a cut would part fully
    identical rows, the rows are ranked instead.
    """
    spark, columns = df.sparkSession, df.columns
    lab, h = (c(label) if label else F.lit(0)), F.col("_hash")
    tie = _orderable(df, {id_col, label})
    df = df.withColumn("_hash", F.coalesce(hash32(c(id_col), seed), F.lit(-1)))       # no id: first
    prefix = F.shiftright(h, 32 - PREFIX_BITS).cast("int")
    key = F.struct(h.alias("h"), c(id_col).alias("id"), *[c(t).alias(f"t{i}") for i, t in enumerate(tie)])
    counts: dict = {}
    for r in df.groupBy(lab.alias("lab"), prefix.alias("p")).count().collect():
        counts.setdefault(r["lab"], {})[r["p"]] = r["count"]
    whole, want = {}, []                        # (label, cut) -> all or nothing; (label, cut, bucket, rank in it)
    for value, by_prefix in counts.items():
        n = sum(by_prefix.values())
        for i, target in enumerate(targets):
            need = target(n)
            if need <= 0 or need >= n:
                whole[value, i] = need > 0
                continue
            for p in sorted(by_prefix):
                if need <= by_prefix[p]:
                    want.append((value, p, i, need))
                    break
                need -= by_prefix[p]
    kind = df.select(lab.alias("lab")).schema["lab"].dataType.simpleString()
    keyed = df.select(lab.alias("lab"), prefix.alias("p"), key.alias("key"))
    found = {}
    if want:
        asked = F.broadcast(spark.createDataFrame(want, f"al {kind}, ap int, cut int, need long"))   # a row per label and cut
        same = F.col("lab").eqNullSafe(F.col("al")) & (F.col("p") == F.col("ap"))
        bucket = keyed.join(F.broadcast(spark.createDataFrame(sorted({w[:2] for w in want}, key=str), f"al {kind}, ap int")), same, "left_semi")
        run = cumulative(bucket.groupBy("lab", "p", "key").agg(F.count(F.lit(1)).alias("n")), "key", ["n"], key_cols=["lab", "p"])
        hits = run.join(asked, same).where("n_cum >= need AND n_cum - n < need").collect()
        if any(r["n_cum"] != r["need"] for r in hits):
            return _ranked_first(df.drop("_hash"), id_col, label, seed, targets)
        found = {(r["lab"], r["cut"]): r["key"] for r in hits}
    struct = keyed.schema["key"].dataType
    schema = T.StructType([T.StructField("_lab", keyed.schema["lab"].dataType)] + [
        f for i in range(len(targets)) for f in (T.StructField(f"_all{i}", T.BooleanType()), T.StructField(f"_key{i}", struct))])
    rows = [(v, *[x for i in range(len(targets)) for x in (whole.get((v, i), False), found.get((v, i)))]) for v in counts]
    cuts = spark.createDataFrame(rows, schema)                                      # one row per label
    out = df.join(F.broadcast(cuts), lab.eqNullSafe(F.col("_lab")))

    def within(cut: str):
        """Whether a row is not behind the cut: its hash tells, but for rows of the cut's own hash."""
        at = F.col(f"{cut}.h")
        return F.when(h != at, h < at).otherwise(key <= F.col(cut))

    return out.select(*[c(x) for x in columns], *[
        F.when(F.col(f"_all{i}"), True).when(F.col(f"_key{i}").isNull(), False).otherwise(within(f"_key{i}")).alias(f"_first{i}")
        for i in range(len(targets))])


def _ranked_first(df, id_col, label, seed, targets) -> DataFrame:
    r = hash_rank(df, id_col, label, seed)
    sizes = {x["n_label"] for x in r.select("n_label").distinct().collect()}        # one number per label
    return r.select(*[c(x) for x in df.columns], *[
        (F.col("rank") <= F.create_map(*[F.lit(v) for n in sorted(sizes) for v in (n, t(n))])[F.col("n_label")]).alias(f"_first{i}")
        for i, t in enumerate(targets)])


def _share(pct: int) -> Callable[[int], int]:
    """round(n * pct / 100) in integer arithmetic (half up)."""
    return lambda n: (n * pct + 50) // 100


# E1
def split_stratified(df: DataFrame, id_col: str, label: str, test_pct: int = 20, seed: int = 42,
                     out: str = "split") -> DataFrame:
    r = first_of_rank(df, id_col, label, seed, [_share(100 - test_pct)])
    return r.withColumn(out, F.when(F.col("_first0"), "train").otherwise("test")).drop("_first0")


# E2
def split_three_way(df: DataFrame, id_col: str, label: str, pcts: Sequence[int] = (80, 10, 10),
                    seed: int = 42, out: str = "split") -> DataFrame:
    r = first_of_rank(df, id_col, label, seed, [_share(pcts[0]), _share(pcts[0] + pcts[1])])
    s = F.when(F.col("_first0"), "train").when(F.col("_first1"), "val").otherwise("test")
    return r.withColumn(out, s).drop("_first0", "_first1")


# E3
def slice_partition(df: DataFrame, mmtc: str = "slice_2:mMTC", urllc: str = "slice_3:URLLC",
                    out: str = "slice") -> DataFrame:
    """Slice label from the two indicators; eMBB when neither; 'ALL' when absent (fallback)."""
    if mmtc in df.columns and urllc in df.columns:
        s = (F.when(c(mmtc) == 1, "mMTC").when(c(urllc) == 1, "URLLC")
             .when((c(mmtc) == 0) & (c(urllc) == 0), "eMBB"))
    else:
        s = F.lit("ALL")
    return df.withColumn(out, s)


# E4
def proto_partition(df: DataFrame, tcp: str = "Proto_TCP", out: str = "proto") -> DataFrame:
    """TCP where the TCP one-hot is 1, UDP where it is 0 (UDP = not TCP); 'ALL' without it."""
    if tcp in df.columns:
        return df.withColumn(out, F.when(c(tcp) == 1, "TCP").when(c(tcp) == 0, "UDP"))
    return df.withColumn(out, F.lit("ALL"))


# E5
def kfold(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    r = hash_rank(df, id_col, label, seed)
    return r.withColumn(out, ((F.col("rank") - 1) % k).cast("int")).drop("rank", "n_label")


# E6
def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: count, balanced weight n / (2 n_c); imbalance ratio neg / pos."""
    g = df.groupBy(c(label).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    t = g.agg(F.sum("n_c").alias("n"),
              F.sum(F.when(F.col("label") == 0, F.col("n_c"))).alias("neg"),
              F.sum(F.when(F.col("label") == 1, F.col("n_c"))).alias("pos"))
    return g.crossJoin(t).select(  # t is one row
        "label", "n_c", (F.col("n") / (F.lit(2.0) * F.col("n_c"))).alias("weight"),
        F.try_divide(F.col("neg").cast("double"), F.col("pos")).alias("imbalance_ratio"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(F.col("label").alias("_lab"), F.col("weight").alias(out))
    return df.join(F.broadcast(w), c(label) == F.col("_lab")).drop("_lab")  # <= 2 rows


# E7
def shuffle_rank(df: DataFrame, id_col: str, seed: int = 42, out: str = "order") -> DataFrame:
    return hash_rank(df, id_col, None, seed, out).drop("n_label")


# E8
def gaussian(id_col: Column, seed: int, j: int) -> Column:
    """Standard normal from two id-hash uniforms (Box-Muller); a pair of streams per feature j."""
    u1 = uniform(id_col, seed + NOISE_STREAM + j, HASH_MULT)
    u2 = uniform(id_col, seed + NOISE_STREAM + j, HASH_MULT_2)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def inject_select(df: DataFrame, id_col: str, fraction: float = ANOMALY_FRACTION, seed: int = 42) -> DataFrame:
    """Mark floor(f * n) rows (lowest rank of the choice stream) and give each a profile 0..3."""
    r = first_of_rank(df, id_col, None, seed + CHOICE_STREAM, [lambda n: math.floor(fraction * n)])
    chosen = F.col("_first0")
    prof = F.pmod(hash32(c(id_col), seed + PROFILE_STREAM), F.lit(len(ATTACK_PROFILES))).cast("int")
    return r.withColumn("injected", chosen.cast("int")).withColumn("profile", F.when(chosen, prof)).drop("_first0")


def inject_noise(df: DataFrame, id_col: str, label: str, features: Sequence[str],
                 fraction: float = ANOMALY_FRACTION, seed: int = 42,
                 scale_by_std: dict[str, float] | None = None) -> DataFrame:
    """Add N(0, multiplier) (optionally x feature std) to the chosen rows' profile
    features and set their label to 1; other rows pass through unchanged.  With
    ``scale_by_std`` = the fitted scaler's deviations, raw features get the noise that
    N(0, multiplier) is in the scaled space."""
    d = inject_select(df, id_col, fraction, seed)
    names = list(ATTACK_PROFILES)
    drawn = {f: f"_g{j}" for j, f in enumerate(features) if any(f in p["features"] for p in ATTACK_PROFILES.values())}
    base = d.columns
    d = d.select("*", *[F.when(F.col("injected") == 1, gaussian(c(id_col), seed, j + 1)).alias(f"_g{j}")
                        for j, f in enumerate(features) if f in drawn])   # each draw is computed once
    new = {}
    for f in features:
        noise = F.lit(0.0)
        for p, name in enumerate(names):
            prof = ATTACK_PROFILES[name]
            if f in prof["features"]:
                sd = prof["multiplier"] * ((scale_by_std or {}).get(f, 1.0))
                noise = F.when(F.col("profile") == p, F.col(drawn[f]) * F.lit(sd)).otherwise(noise)
        new[f] = F.when(F.col("injected") == 1, c(f) + noise).otherwise(c(f))
    new[label] = F.when(F.col("injected") == 1, F.lit(1)).otherwise(c(label))
    return d.select(*[new[x].alias(x) if x in new else c(x) for x in base])


# E9
def inject_structured(benign: DataFrame, id_col: str, label: str, n_total: int | None = None,
                      seed: int = 42) -> DataFrame:
    """Append perturbed copies of the first benign rows (hash order): SYN flood
    (+U(3,8) on SYN columns), port scan (x U(0.01,0.1) on duration/IAT columns),
    DDoS (+U(4,10) on byte/packet columns); thirds of ``n_total``."""
    def total(n):
        return n if n_total is None else n_total

    r = first_of_rank(benign, id_col, None, seed, [total, lambda n: total(n) // 3, lambda n: total(n) - 2 * (total(n) // 3)])
    base = r.where("_first0")
    cols = [x for x in benign.columns if x not in (id_col, label)]
    syn = [x for x in cols if "SYN" in x.upper()]
    dur = [x for x in cols if "Duration" in x or "IAT" in x]
    byt = [x for x in cols if "Bytes" in x or "Packets" in x]

    def variant(name, k, rows, targets, op, lo, hi):
        new = {}
        for j, x in enumerate(targets):
            u = F.lit(lo) + F.lit(hi - lo) * uniform(c(id_col), seed + UNIFORM_STREAM * k + j)
            new[x] = c(x) + u if op == "add" else c(x) * u
        sel = [new[x].alias(x) if x in new else c(x) for x in benign.columns if x != label]
        return (rows.select(*sel, F.lit(1).alias(label), F.lit(name).alias("variant")))

    ben = base.select(*[c(x) for x in benign.columns if x != label], F.lit(0).alias(label),
                      F.lit("benign").alias("variant"))
    a = variant("syn_flood", 1, base.where("_first1"), syn, "add", *SYN_FLOOD_ADD)
    b = variant("port_scan", 2, base.where("_first1"), dur, "mul", *PORT_SCAN_MUL)
    d = variant("ddos", 3, base.where("_first2"), byt, "add", *DDOS_ADD)
    return ben.unionByName(a).unionByName(b).unionByName(d)
