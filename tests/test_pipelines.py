"""The 5G pipeline over the family of datasets: own parameters, Global column order."""
from collections import Counter

from flowlens.operators import pipelines as PL
from flowlens.plans.views import view
from tests.conftest import SF_SMALL


def test_family_is_aligned_to_global_and_fitted_by_dataset(spark):
    df = view(spark, SF_SMALL, "flows_5g")
    out, params = PL.pipeline_5g_family(df)
    alone, p_global = PL.pipeline_5g(df, "Global")
    assert out.columns == ["dataset", *alone.columns] and params["Global"] == p_global
    sizes = {r["dataset"]: r["count"] for r in out.groupBy("dataset").count().collect()}
    want = {r["predicted"]: r["count"] for r in df.groupBy("predicted").count().collect()}
    assert sizes == {"Global": df.count(), **{k: want[v] for k, v in PL.FAMILY_5G.items() if v}}
    mmtc, p = PL.pipeline_5g(df.where("predicted = '2:mMTC'"), "mMTC")
    assert params["mMTC"] == p and p["caps"] != p_global["caps"]
    lacking = [x for x in alone.columns if x not in mmtc.columns]
    assert any(x.startswith("slice_") for x in lacking)          # outside Global the slice column goes
    got = out.where("dataset = 'mMTC'")
    assert got.select(*[f"`{x}`" for x in lacking]).distinct().collect() == [tuple([0] * len(lacking))]
    both = [x for x in alone.columns if x in mmtc.columns]
    rows = lambda d: Counter(tuple(map(str, r)) for r in d.select(*[f"`{x}`" for x in both]).collect())
    assert sum((rows(got) - rows(mmtc.select(*[mmtc[f"`{x}`"].cast(dict(alone.dtypes)[x]).alias(x) for x in both]))).values()) == 0


def test_family_with_an_empty_dataset(spark):
    df = view(spark, SF_SMALL, "flows_5g").where("predicted <> '3:URLLC'")
    out, _ = PL.pipeline_5g_family(df)
    assert out.where("dataset = 'URLLC'").count() == 0 and out.where("dataset = 'eMBB'").count() > 0


def test_only_the_last_step_of_each_dataset_stays_cached(spark):
    kept = lambda: set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    spark.catalog.clearCache()                       # an equal step that another test cached would be shared
    before = kept()
    out, _ = PL.pipeline_5g_family(view(spark, SF_SMALL, "flows_5g"))
    assert len(kept() - before) == len(PL.FAMILY_5G)
    assert out.where("dataset = 'Global'").count() == view(spark, SF_SMALL, "flows_5g").count()
