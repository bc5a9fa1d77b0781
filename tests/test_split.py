"""Cuts found by hash-prefix counts against full ranks."""
import pytest
from pyspark.sql import functions as F

from flowlens import session
from flowlens.functions.exprs import MIX, hash32
from flowlens.operators import split as E


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i // 2 if i % 7 else None, i % 3 if i % 11 else None, float(i % 5) if i % 4 else None, f"s{i % 6}") for i in range(3000)]
    return spark.createDataFrame(data, "id long, y int, v double, s string").repartition(5).persist()


@pytest.mark.parametrize("label", ["y", None])
def test_cuts_equal_ranks(rows, label):
    targets = [lambda n: n * 70 // 100, lambda n: n * 71 // 100, lambda n: 0, lambda n: n, lambda n: n + 5]
    got = E.first_of_rank(rows, "id", label, 7, targets)
    want = E._ranked_first(rows, "id", label, 7, targets)
    cols = ["id", "y", "v", "s", *[f"_first{i}" for i in range(5)]]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.select(cols).collect()), key=key) == sorted(map(tuple, want.select(cols).collect()), key=key)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_cut_through_identical_rows(spark):
    same = spark.createDataFrame([(1, 0)] * 10 + [(2, 1)] * 3, "id long, y int")
    got = E.first_of_rank(same, "id", "y", 7, [lambda n: n // 2])
    assert sorted((r["y"], r["n"]) for r in got.where("_first0").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()) == [(0, 5), (1, 1)]
    assert E.first_of_rank(same.where("false"), "id", "y", 7, [lambda n: n // 2]).count() == 0


def test_a_cut_computes_the_hash_of_a_row_once(rows):
    cut = E.first_of_rank(rows, "id", "y", 7, [lambda n: n // 3, lambda n: n // 2, lambda n: 2 * n // 3])
    hashes = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count(str(MIX))
    assert hashes(cut) <= hashes(rows.select(hash32(F.col("id"), 7)))


def test_a_table_of_one_part_is_dealt_over_several(spark, monkeypatch):
    monkeypatch.setattr(session, "PART_ROWS", 100)
    one = spark.createDataFrame([(i // 2 if i % 7 else None, f"s{i % 6}") for i in range(1000)], "id long, `a.b` string").coalesce(1)
    dealt = session.persist_dealt(one)
    key = lambda r: (r[0] is None, r)
    assert dealt.rdd.getNumPartitions() == 10
    assert sorted(map(tuple, dealt.fillna(-1, ["id"]).collect()), key=key) == sorted(map(tuple, one.fillna(-1, ["id"]).collect()), key=key)
    dealt.unpersist()
    assert session.persist_dealt(one.limit(50)).rdd.getNumPartitions() == 1
