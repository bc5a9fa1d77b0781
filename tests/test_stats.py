"""Distributed running sums, exact quantiles and partition independence."""
import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.functions.stats import cumulative, quantiles_of
from flowlens.operators import split as E
from flowlens.plans.views import view
from tests.conftest import SF_SMALL


def test_cumulative_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g"),
                                     F.lit(1).alias("one"))
    df = df.dropDuplicates(["g", "k"])
    got = cumulative(df, "k", ["one"], key_cols=["g"], parts=7)
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("ref", F.sum("one").over(w))
    bad = got.join(exp, ["g", "k"]).where("one_cum != ref").count()
    assert bad == 0


def test_exact_quantiles_match_numpy(spark):
    df = view(spark, SF_SMALL, "flows_5g").select("Load", "Dur")
    pdf = df.toPandas()
    q = quantiles_of(df, ["Load", "Dur"], [0.01, 0.25, 0.5, 0.99])
    for col in ["Load", "Dur"]:
        ref = np.percentile(pdf[col].dropna().to_numpy(), [1, 25, 50, 99])
        assert np.allclose(q[col], ref, rtol=1e-12, atol=1e-9)


def test_ranks_do_not_depend_on_partitioning(spark):
    df = view(spark, SF_SMALL, "scored")
    outs = []
    for n in (1, 4, 16):
        f = E.kfold(df.repartition(n), "id", "y", 5).groupBy("fold", "y").agg(F.sum("score").alias("s"))
        outs.append(sorted((r["fold"], r["y"], round(r["s"], 6)) for r in f.collect()))
    assert outs[0] == outs[1] == outs[2]


def test_bracketed_quantiles_equal_numpy(spark):
    import numpy as np

    from flowlens.functions.stats import _bracketed_quantiles
    rng = np.random.default_rng(3)
    x = rng.lognormal(0, 3, 20_000)
    ties = rng.integers(0, 7, 20_000).astype(float)
    few = np.where(np.arange(20_000) < 3, np.arange(20_000) * 1.5, np.nan)
    df = spark.createDataFrame(list(zip(x.tolist(), ties.tolist(), few.tolist(), [None] * 20_000)), "x double, t double, f double, z double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for accuracy in (50, 10_000):
        got = _bracketed_quantiles(df.repartition(4), ["x", "t", "f", "z"], probs, accuracy)
        for name, v in (("x", x), ("t", ties), ("f", few)):
            assert np.allclose(got[(name,)], np.nanquantile(v, probs), rtol=1e-12)
        assert got[("z",)] == [None] * 7
    inf = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),)], "x double")
    assert _bracketed_quantiles(inf, ["x"], [0.0, 0.5, 1.0])[("x",)] == [float("-inf"), 1.5, float("inf")]


def test_kde_without_spread(spark):
    from flowlens.operators.profile import kde
    df = spark.createDataFrame([(None, 1.0, 2.0), (None, None, 2.0)], "a double, b double, c double")
    assert kde(df, "a").collect() == []
    for name in ("b", "c"):
        rows = kde(df, name, 5).collect()
        assert len(rows) == 5 and all(r["density"] is None for r in rows)


def test_ordinal_codes_of_many_values_and_refused_categories(spark):
    import pytest

    from flowlens.operators import clean as C
    df = spark.range(500).selectExpr("id", "CASE WHEN id % 50 = 0 THEN NULL ELSE concat('v', id % 77) END AS s", "id % 5 AS k")
    got = {(r["id"]): r["s"] for r in C.ordinal_codes(df, ["s"]).collect()}
    values = sorted({f"v{i % 77}" for i in range(500) if i % 50})
    assert got == {i: -1 if i % 50 == 0 else values.index(f"v{i % 77}") for i in range(500)}
    assert C.fit_categories(df, ["s"], 77)["s"] == values
    with pytest.raises(ValueError):
        C.fit_categories(df, ["s", "k"], 76)


def test_fits_of_several_passes_read_their_input_once(spark):
    from flowlens.operators import clean as C
    from flowlens.operators import profile as B

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    def rows():
        return spark.range(300, numPartitions=2).mapInPandas(counted, "id long").selectExpr(
            "CAST(id AS DOUBLE) AS x", "CASE WHEN id % 3 > 0 THEN CAST(id % 37 AS DOUBLE) END AS y")

    fits = [lambda d: B.describe_numeric(d).collect(), lambda d: B.feature_summary(d).collect(), lambda d: B.outlier_report(d).collect(),
            lambda d: B.boxplot_stats(d).collect(), lambda d: C.fit_medians(d), lambda d: C.fit_winsor_bounds(d, ["x", "y"])]
    for fit in fits:
        df, before = rows(), read.value
        assert fit(df)
        assert read.value - before == 300 and not df.storageLevel.useMemory


def test_sums_of_a_cached_table_take_one_stage(spark):
    import numpy as np

    from flowlens.functions.stats import partition_sums

    df = spark.range(1000).repartition(5)
    total = lambda pdf: np.array([pdf["id"].sum(), len(pdf)], float)
    cached = df.persist()
    cached.count()
    sc = spark.sparkContext
    sc.setJobGroup("sums_of_cached", "")
    try:
        assert partition_sums(cached, total, 2).tolist() == [499500.0, 1000.0]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("sums_of_cached")]
    ran = {s for j in jobs for s in j.stageIds if sc.statusTracker().getStageInfo(s)}
    assert len(jobs) == 1 and len([s for s in ran if sc.statusTracker().getStageInfo(s).numCompletedTasks]) == 1
    assert partition_sums(cached, total, 2, fan_in=2).tolist() == [499500.0, 1000.0]
    cached.unpersist()
    assert partition_sums(spark.range(1000), total, 2).tolist() == [499500.0, 1000.0]
