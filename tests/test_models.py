"""Detectors, calibrators, gate and bundle on small fits."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.functions.exprs import hash32, hash32_array
from flowlens.operators import models as Mo
from flowlens.operators import project as P
from flowlens.operators import score as S
from flowlens.plans.q_split import projected_labelled_6g
from flowlens.plans.views import view
from tests.conftest import SF_SMALL

FEATS = P.UNIFIED_FEATURES


@pytest.fixture(scope="module")
def data(spark):
    from flowlens.operators import clean as C
    from flowlens.operators import split as E
    df = projected_labelled_6g(spark, SF_SMALL)
    df = C.sanitize(df, FEATS)
    return E.inject_noise(df, "flow_id", "Label", FEATS, 0.3).drop("injected", "profile").persist()


def test_calibrator_range(data):
    a, b = Mo.fit_sigmoid_calibrator(data, "u_pkt_rate", "Label")
    out = data.select(S.apply_calibrator(F.col("u_pkt_rate"), a, b).alias("p")).agg(F.min("p"), F.max("p")).first()
    assert 0.0 <= out[0] <= out[1] <= 1.0


def test_linear_autoencoder_mse_nonnegative(data):
    ae = Mo.fit_linear_autoencoder(data.where("Label = 0"), FEATS, 6)
    m = Mo.reconstruction_mse(data, ae).agg(F.min("mse"), F.count("mse")).first()
    assert m[0] >= 0 and m[1] == data.count()


def test_isolation_forest_scores(data):
    model = Mo.fit_isolation_forest(data.where("Label = 0"), "flow_id", FEATS, n_trees=20, sample=64)
    assert len(model["trees"]) == 20
    s = Mo.isolation_score(data.select("flow_id", "Label", *FEATS), model).agg(F.min("if_score"), F.max("if_score")).first()
    assert 0.0 < s[0] <= s[1] < 1.0


def test_gate_weights_are_a_distribution(data):
    d = data.withColumn("scores", F.array(*[F.col(c) for c in ["u_syn", "u_rst", "u_is_tcp", "u_is_udp", "u_is_other"]]).cast("array<double>"))
    g = Mo.train_gate(d, FEATS, "scores", "Label", epochs=3, lr=0.01)
    w = Mo.gate_weights(d, g)
    r = w.select(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x).alias("s"), F.array_min("weights").alias("m")).agg(
        F.max(F.abs(F.col("s") - 1)), F.min("m")).first()
    assert r[0] < 1e-9 and r[1] >= 0


def test_pca_2d(spark):
    out, ev = Mo.pca_2d(view(spark, SF_SMALL, "embeddings"), "embedding", 2)
    assert len(ev) == 2 and out.select(F.size("pc")).first()[0] == 2


def test_dense_autoencoder_error_in_sql_and_detection(spark, data):
    from flowlens.operators import clean as C
    from flowlens.operators import evaluate as G
    from flowlens.operators import neural as N
    scaled = C.standard_scale(data, C.fit_standard_scaler(data.where("Label = 0"), P.NUMERIC_FEATURES)).persist()
    net = N.fit_dense_autoencoder(scaled.where("Label = 0"), FEATS, "flow_id", epochs=40)
    got = N.network_error(scaled, net)
    # the exported weights, written out in SQL
    got.createOrReplaceTempView("dense_rows")
    prev, inner = [f"coalesce(CAST(`{f}` AS DOUBLE), 0)" for f in FEATS], "dense_rows"
    first, sql = [f"f{i}" for i in range(16)], "SELECT flow_id, mse, " + ", ".join(f"{e} AS f{i}" for i, e in enumerate(prev)) + " FROM dense_rows"
    names = first
    for k, (w, b, act) in enumerate(net["layers"]):
        cols = []
        for j in range(len(b)):
            z = " + ".join([f"CAST({b[j]!r} AS DOUBLE)", *[f"CAST({w[i][j]!r} AS DOUBLE) * {n}" for i, n in enumerate(names)]])
            cols.append(f"{f'greatest({z}, 0)' if act == 'relu' else z} AS l{k}_{j}")
        sql, names = f"SELECT *, {', '.join(cols)} FROM ({sql})", [f"l{k}_{j}" for j in range(len(b))]
    error = " + ".join(f"({a} - {n}) * ({a} - {n})" for a, n in zip(first, names))
    worst = spark.sql(f"SELECT max(abs(({error}) / 16 - mse) / (1 + mse)) AS d, count(*) AS n FROM ({sql})").first()
    assert worst["d"] < 1e-9 and worst["n"] == data.count()
    assert len(net["layers"]) == 4 and [len(b) for _, b, _ in net["layers"]] == [10, 6, 10, 16]
    mean = scaled.where("Label = 0").agg(*[F.var_pop(f).alias(f) for f in FEATS]).first()
    benign = got.where("Label = 0").agg(F.avg("mse")).first()[0]
    assert benign < sum(mean) / 16                       # better than the mean row
    assert G.roc_auc(got, "Label", "mse").first()[0] > 0.8


def test_many_partitions_train_like_one(data, monkeypatch):
    from flowlens.operators import neural as N
    one = N.fit_dense_autoencoder(data.where("Label = 0"), FEATS, "flow_id", epochs=3)
    monkeypatch.setattr(N, "BLOCK", 200)
    many = N.fit_dense_autoencoder(data.where("Label = 0").repartition(4), FEATS, "flow_id", epochs=3)
    assert many["validation_loss"] < 3 * one["validation_loss"] and [len(b) for _, b, _ in many["layers"]] == [10, 6, 10, 16]
    none = N.fit_dense_autoencoder(data.where("false"), FEATS, "flow_id", epochs=3)
    assert [len(b) for _, b, _ in none["layers"]] == [10, 6, 10, 16]


def small_pipeline(spark, data):
    from flowlens.operators import boosting as Bo
    from flowlens.operators import bundle as B
    from flowlens.operators import neural as N
    trees = Bo.fit_boosted(data, FEATS, "Label", {"eMBB": F.lit(True), "URLLC": F.lit(True)}, "flow_id", rounds=5, depth=3)
    net = N.fit_dense_autoencoder(data.where("Label = 0"), FEATS, "flow_id", epochs=2)
    scored = data.withColumn("scores", F.array(*[F.col(c) for c in ["u_syn", "u_rst", "u_is_tcp", "u_is_udp", "u_is_other"]]).cast("array<double>"))
    gate = Mo.train_gate(scored, FEATS, "scores", "Label", epochs=2)
    moments = {f: (0.5, 2.0) for f in P.NUMERIC_FEATURES}
    return B.assemble(moments, trees, {"TCP_AE": net}, {"eMBB": (3.0, -1.0)}, gate, {"TCP_AE": (0.0, 5.0)})


def test_bundle_roundtrip_and_checks(spark, data, tmp_path):
    import json

    from pyspark.ml import PipelineModel

    from flowlens.operators import bundle as B
    model, path = small_pipeline(spark, data), str(tmp_path / "bundle")
    B.save_bundle(spark, path, model, {"seed": 1})
    again, doc = B.load_bundle(spark, path, FEATS)
    assert doc["features"] == FEATS and doc["seed"] == 1
    rows = data.select(F.col("flow_id").alias("id"), *FEATS)

    def probs(m):
        return [tuple(r) for r in PipelineModel(m.stages[1:]).transform(rows).select("id", "prob", "pred", "dominant_expert", "scores").orderBy("id").collect()]

    first = probs(model)
    assert probs(again) == first and all(0 < r[1] < 1 and r[4][1] == r[4][4] == 0.0 for r in first)
    with pytest.raises(ValueError):
        B.load_bundle(spark, path, list(reversed(FEATS)))
    other = str(tmp_path / "other")
    B.save_bundle(spark, other, model)
    spark.createDataFrame([(json.dumps(doc | {"bundle_version": "0"}),)], "value string").write.mode("overwrite").text(f"{other}/manifest")
    with pytest.raises(ValueError):
        B.load_bundle(spark, other)


def test_stream_scores_equal_batch_scores(spark, data, tmp_path):
    from flowlens.operators import bundle as B
    from flowlens.plans.q_project import cic_flows, clean_6g_rates
    from flowlens.streaming import stream as ST
    path = str(tmp_path / "bundle")
    B.save_bundle(spark, path, small_pipeline(spark, data))
    flows = clean_6g_rates(cic_flows(spark, SF_SMALL))
    want = B.load_bundle(spark, path)[0].transform(flows).select("id", "schema_name", "prob", "pred", "dominant_expert")
    inp, sink = str(tmp_path / "in"), str(tmp_path / "out")
    flows.repartition(3).write.parquet(inp)
    ST.run_to_end(ST.score_stream(spark, inp, flows.schema, ST.bundle_scorer(spark, path), sink, str(tmp_path / "ck")))
    got = spark.read.parquet(sink)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_trained_gate_prefers_the_good_expert(data):
    from flowlens.operators import clean as C
    scaled = C.standard_scale(data, C.fit_standard_scaler(data, P.NUMERIC_FEATURES))
    d = scaled.withColumn("scores", F.array((F.col("Label") * 0.9 + 0.05), *[F.lit(0.5)] * 4))
    g = Mo.train_gate(d, FEATS, "scores", "Label", "flow_id", epochs=40, lr=0.01)
    mean = Mo.gate_weights(d, g).agg(F.avg(F.col("weights")[0])).first()[0]
    assert mean > 0.6


def test_calibrator_separates_classes(data):
    d = data.withColumn("s", F.col("Label") + F.pmod(F.xxhash64("flow_id"), F.lit(100)) / 60)
    a, b = Mo.fit_sigmoid_calibrator(d, "s", "Label")
    r = d.groupBy("Label").agg(F.avg(S.apply_calibrator(F.col("s"), a, b)).alias("p")).orderBy("Label").collect()
    assert a > 0 and r[1]["p"] > r[0]["p"] + 0.2


def test_sample_of_the_isolation_forest_is_that_of_the_column_hash(spark):
    ids = [-5, 0, 7, 2 ** 33 + 1, 2 ** 62, *range(100, 700)]
    df = spark.createDataFrame([(i, float(k % 17)) for k, i in enumerate(ids)] + [(None, 1.0)], "id long, x double")
    once = [r[0] for r in df.where("id IS NOT NULL").select(hash32(F.col("id"), 9)).collect()]
    assert hash32_array(np.array(ids), 9).tolist() == once
    m = Mo.fit_isolation_forest(df, "id", ["x"], n_trees=6, sample=16, seed=9)
    again = spark.createDataFrame([(h,) for h in once], "h long")
    for t, tree in enumerate(m["trees"]):
        below = again.where(hash32(F.col("h") + t * 97531, 10) < 2.0 * 16 / len(ids + [None]) * 2 ** 32).count()
        assert sum(size for feature, _, _, _, size in tree if feature < 0) == min(16, below)


def test_logistic_regression_on_nearly_separable_rows_takes_few_passes(spark, monkeypatch):
    passes, sums = [], Mo.partition_sums
    monkeypatch.setattr(Mo, "partition_sums", lambda *a, **k: passes.append(1) or sums(*a, **k))
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=600), rng.integers(0, 2, 600), rng.exponential(50.0, 600), np.full(600, 3.0)])
    y = ((x[:, 1] > 0) | (rng.random(600) < .2)).astype(int)
    w = np.where(y > 0, 0.7, 1.4)
    df = spark.createDataFrame([(*map(float, r), int(k), float(v)) for r, k, v in zip(x, y, w)], "a double, b double, c double, d double, y int, w double")
    m = Mo.train_lr(df, ["a", "b", "c", "d"], "y", "w")
    b, z = np.array(m.coefficients), x @ np.array(m.coefficients) + m.intercept
    p = 1 / (1 + np.exp(-z))
    assert b[3] == 0 and len(passes) < 40
    slope = np.append((x[:, :3].T @ (w * (p - y)) + b[:3]) / x[:, :3].std(0), (w * (p - y)).sum())      # at the least loss: none
    assert np.allclose(slope, 0, atol=0.05)
    got = Mo.positive_probability(m.transform(df)).select("p").toPandas()["p"]
    assert np.allclose(got, p)
    with pytest.raises(ValueError):
        Mo.train_lr(df.withColumn("a", F.when(F.col("a") > 0, F.col("a"))), ["a", "b"], "y", "w")


def test_gate_trains_on_scalar_columns(spark, monkeypatch):
    from flowlens.operators import neural as N
    sent, fit = [], N.fit_epochs
    monkeypatch.setattr(N, "fit_epochs", lambda data, *a, **k: sent.append(data.dtypes) or fit(data, *a, **k))
    rows = [(i, float(i % 7), [float(i % 2), 0.5, 0.25], i % 2) for i in range(200)]
    g = Mo.train_gate(spark.createDataFrame(rows, "id long, x double, s array<double>, y int"), ["x"], "s", "y", "id", epochs=2)
    assert {t for n, t in sent[0] if n.startswith("_s")} == {"double"} and len([n for n, _ in sent[0] if n.startswith("_s")]) == 3
    assert np.array(g["layers"][-1][0]).shape[1] == 3
