"""Independence of the hash streams behind splits, injection and noise; log lines; large counts."""

import json

import numpy as np
from pyspark.sql import functions as F

from flowlens.functions.exprs import hash32_sql, uniform
from flowlens.operators import split as E


def _draws(spark, *cols):
    return np.array(spark.range(40_000).select(F.col("id") * 10 + 1).toDF("id").select(*cols).collect(), float)


def test_uniform_streams_are_uniform_and_independent(spark):
    u = _draws(spark, *[uniform(F.col("id"), s) for s in (1, 2, 3, 1001, 2001)])
    assert u.min() < 0.001 and u.max() > 0.999
    assert np.allclose(u.mean(0), 0.5, atol=0.01) and np.allclose(u.std(0), 12 ** -0.5, atol=0.01)
    assert np.abs(np.corrcoef(u.T) - np.eye(5)).max() < 0.02


def test_noise_is_standard_normal_and_independent_per_feature(spark):
    g = _draws(spark, *[E.gaussian(F.col("id"), 42, j) for j in range(1, 6)])
    assert np.allclose(g.mean(0), 0, atol=0.03) and np.allclose(g.std(0), 1, atol=0.05)
    assert np.abs(np.corrcoef(g.T) - np.eye(5)).max() < 0.05


def test_injected_rows_get_full_range_noise(spark):
    df = spark.range(20_000).select(F.col("id"), F.lit(0).alias("Label"), F.lit(0.0).alias("u_syn"), F.lit(0.0).alias("u_rst"))
    out = E.inject_noise(df, "id", "Label", ["u_syn", "u_rst"], 0.15).where("injected = 1").toPandas()
    assert len(out) == 3000 and (out["Label"] == 1).all()
    assert np.allclose(out.groupby("profile").size(), 750, atol=120)
    syn = out.loc[out["profile"] == 0, "u_syn"]
    assert abs(syn.std() / 8.0 - 1) < 0.1 and abs(syn.mean()) < 1


def test_structured_uniforms_fill_their_ranges(spark):
    df = spark.range(9_000).select(F.col("id"), F.lit(0).alias("Label"), F.lit(1.0).alias("SYN Flag Count"), F.lit(1.0).alias("Flow Duration"))
    out = E.inject_structured(df, "id", "Label").toPandas()
    add = out.loc[out["variant"] == "syn_flood", "SYN Flag Count"] - 1
    mul = out.loc[out["variant"] == "port_scan", "Flow Duration"]
    assert 3 <= add.min() < 3.05 and 7.95 < add.max() <= 8
    assert 0.01 <= mul.min() < 0.011 and 0.099 < mul.max() <= 0.1


def test_choice_does_not_follow_the_split(spark):
    df = spark.range(20_000).select(F.col("id"), F.lit(0).alias("Label"))
    s = E.split_three_way(df, "id", "Label", (80, 10, 10))
    part = E.inject_select(df, "id", 0.15).join(s.select("id", "split"), "id")
    share = {r["split"]: r["m"] for r in part.groupBy("split").agg(F.avg("injected").alias("m")).collect()}
    assert all(abs(m - 0.15) < 0.03 for m in share.values()) and len(share) == 3


def test_hash_equals_sql(spark, duck):
    from flowlens.functions.exprs import hash32
    got = [r[0] for r in spark.range(500).select(hash32(F.col("id") * 7_000_000_019, 5)).collect()]
    assert got == [r[0] for r in duck.execute(f"SELECT {hash32_sql('i * 7000000019', 5)} FROM range(500) t(i) ORDER BY i").fetchall()]


def test_log_timestamps(spark, tmp_path):
    from flowlens.sources import io as A
    lines = [{"request_id": "a", "timestamp": "2024-05-02T10:00:00.123456+00:00", "n_rows": 1},
             {"request_id": "b", "timestamp": "2024-05-02T10:00:00+02:00"}, {"request_id": "c", "timestamp": "2024-05-02T10:00:00"},
             {"request_id": "d", "timestamp": "not a time"}, {"request_id": "e", "timestamp": ""}, {"request_id": "f"},
             {"request_id": "g", "timestamp": "2024-01-01T00:00:00+00:00"}]
    day = tmp_path / "dt=2024-05-02"
    day.mkdir()
    (day / "log.json").write_text("\n".join(map(json.dumps, lines)) + "\n{broken\n")
    got = {r["request_id"]: r["ts"] for r in A.read_logs(spark, str(tmp_path), 7, "2024-05-03 00:00:00").collect()}
    assert set(got) == {"a", "b", "c", "e", "f"} and got["b"].hour == 8 and got["c"].hour == 10 and got["e"] is None


def test_roc_auc_of_huge_counts(spark, monkeypatch):
    from flowlens.operators import evaluate as G
    big = spark.createDataFrame([(0.9, 4_000_000_000, 1_000_000_000), (0.1, 1_000_000_000, 4_000_000_000)], "score double, pos long, neg long")
    monkeypatch.setattr(G, "score_counts", lambda *a: big)
    auc = G.roc_auc(big, "y", "score").first()["roc_auc"]
    assert abs(auc - (0.8 * 0.8 + 0.5 * 2 * 0.8 * 0.2)) < 1e-12
