"""Evaluation of stored scores against SQL over the exported table; folds never score their own training rows."""
import duckdb
import pytest
from pyspark.sql import functions as F

from flowlens.operators import boosting as Bo
from flowlens.operators import models as Mo
from flowlens.operators import score as S
from flowlens.operators import split as E
from flowlens.plans import q_evaluate as Q


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scored") / "rows")
    r = lambda k: (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(101)) / 100.0)
    y = (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int")
    w = [r(20 + k) + 0.01 for k in range(5)]
    df = spark.range(3000).withColumn("y", y).withColumn("domain", F.when(F.col("id") < 1200, "5G").otherwise("6G"))
    df = df.withColumn("scores", F.array(*[F.least(F.lit(1.0), r(k) * 0.7 + F.col("y") * 0.3) for k in range(5)]))
    df = df.withColumn("weights", F.array(*[x / sum(w[1:], w[0]) for x in w]))
    df = df.withColumn("prob", S.weighted_combine(F.col("weights"), F.col("scores"))).withColumn("pred", (F.col("prob") >= 0.5).cast("int"))
    df.write.parquet(path)
    return path


def _compare(df, sql, path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW rows AS SELECT *, prob AS score FROM read_parquet('{path}/*.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = sorted(dict(zip(names, r)).items() and tuple(dict(zip(names, r))[k] for k in sorted(names)) for r in cur.fetchall())
    got = sorted(tuple(r[k] for k in sorted(df.columns)) for r in df.collect())
    assert sorted(df.columns) == sorted(names) and len(got) == len(want)
    for g, w in zip(got, want):
        assert all(a == pytest.approx(b, rel=1e-7) if isinstance(a, float) else a == b for a, b in zip(g, w))


def test_domain_metrics_of_exported_scores(spark, scored):
    sql = f"""WITH m AS ({Q.metrics_sql(Q.conf_sql('rows', 'y', 'pred', ('domain',)), 'domain, ')}),
        a AS ({Q.auc_sql('rows', 'y', 'prob', ('domain',))}), p AS ({Q.ap_sql('rows', 'y', 'prob', ('domain',))})
        SELECT m.domain, tp, fp, tn, fn, accuracy, precision, recall, f1, roc_auc, average_precision
        FROM m JOIN a ON m.domain = a.domain JOIN p ON m.domain = p.domain"""
    _compare(Q.domain_metrics(spark.read.parquet(scored), "prob"), sql, scored)


def test_ablation_of_exported_scores(spark, scored):
    hard = "scores[list_position(weights, list_max(weights))]"
    sql = f"""WITH ab AS (SELECT y, 'trained' AS config, prob AS p FROM rows UNION ALL SELECT y, 'uniform', list_sum(scores) / 5 FROM rows
        UNION ALL SELECT y, 'hard', {hard} FROM rows UNION ALL SELECT y, 'oracle', CASE WHEN y = 1 THEN list_max(scores) ELSE list_min(scores) END FROM rows),
        abp AS (SELECT *, CAST(p >= 0.5 AS INT) AS pred FROM ab),
        m AS ({Q.metrics_sql(Q.conf_sql('abp', 'y', 'pred', ('config',)), 'config, ')}),
        a AS ({Q.auc_sql('ab', 'y', 'p', ('config',))}), p AS ({Q.ap_sql('ab', 'y', 'p', ('config',))})
        SELECT m.config, f1, recall, precision, roc_auc, average_precision FROM m JOIN a ON m.config = a.config JOIN p ON m.config = p.config"""
    _compare(Q.ablation_table(spark.read.parquet(scored)), sql, scored)


def test_folds_are_scored_by_models_of_the_other_folds(spark):
    df = E.kfold(spark.range(600).withColumn("y", (F.col("id") % 3 == 0).cast("int")), "id", "y", 4).persist()

    def remember(train):
        seen = train.select("id").withColumn("score", F.lit(1))
        return lambda d: d.join(seen, "id", "left").withColumn("score", F.coalesce("score", F.lit(0)))

    def size(train):
        n = train.count()
        return lambda d: d.withColumn("score", F.lit(n))

    got = Mo.cross_validated_scores(df, ["id"], "y", {"remember": remember, "size": size}, keep=["id"]).toPandas()
    assert len(got) == 1200 and (got.groupby("id").size() == 2).all()
    assert (got.loc[got["model"] == "remember", "score"] == 0).all()
    assert (got.loc[got["model"] == "size", "score"] == 450).all()


def test_fresh_boosted_models_learn_in_every_fold(spark):
    df = spark.range(900).withColumn("x", (F.col("id") % 30).cast("double")).withColumn("y", (F.col("x") > 12).cast("int"))
    df = E.kfold(df, "id", "y", 3).persist()

    def fit(train):
        m = Bo.fit_boosted(train, ["x"], "y", id_col="id", rounds=10, depth=2, step=0.5)
        return lambda d: d.withColumn("score", Bo.boosted_probability(m, ["x"])[0])

    got = Mo.cross_validated_scores(df, ["x"], "y", {"boosted": fit}, keep=["id"])
    right = got.groupBy("fold").agg(F.avg(((F.col("score") > 0.5).cast("int") == F.col("y")).cast("double")).alias("a")).collect()
    assert len(right) == 3 and all(r["a"] == 1.0 for r in right)
