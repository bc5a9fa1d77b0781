"""Streaming results equal the batch results."""
from flowlens.plans.registry import load_all
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_score_equals_batch(spark):
    reg = load_all()
    s = reg["stream_score"].fn(spark, SF_SMALL)
    b = reg["project_6g"].fn(spark, SF_SMALL)
    assert _rows(s.select(*b.columns)) == _rows(b)


def test_stream_drift_equals_batch_report(spark):
    reg = load_all()
    s = reg["stream_drift"].fn(spark, SF_SMALL).first().asDict()
    b = reg["drift_report"].fn(spark, SF_SMALL).first().asDict()
    assert s == b


def test_stream_windows_are_closed_windows(spark):
    df = load_all()["stream_windows"].fn(spark, SF_SMALL)
    assert df.count() > 0
    assert df.where("window_end <= window_start").count() == 0


def test_replayed_batches_and_late_days_do_not_change_the_report(spark, tmp_path):
    """State per day and batch: a replay replaces itself, days outside the window are not read."""
    from pyspark.sql import functions as F

    from flowlens.operators import drift as D
    from flowlens.plans.views import view
    from flowlens.streaming import stream as ST
    log = view(spark, SF_SMALL, "prediction_log")
    inp, extra = str(tmp_path / "in"), [str(tmp_path / x) for x in ("log", "state", "rep")]
    half = F.pmod(F.xxhash64("request_id"), F.lit(2))
    log.where(half == 0).coalesce(1).write.parquet(inp)
    args = ("2024-01-24", "2024-01-30")
    ST.run_to_end(ST.drift_stream(spark, inp, log.schema, *extra, str(tmp_path / "ck1"), *args))
    log.where(half == 1).withColumn("ts", F.col("ts")).coalesce(1).write.mode("append").parquet(inp)
    ST.run_to_end(ST.drift_stream(spark, inp, log.schema, *extra, str(tmp_path / "ck1"), *args))
    cut = F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")
    want = D.drift_report(log.where(F.col("ts") < cut), log.where(F.col("ts") >= cut)).first().asDict()

    def newest():
        rep = spark.read.parquet(extra[2])
        return rep.orderBy(F.desc("batch_id")).drop("batch_id").first().asDict()

    assert newest() == want
    # the second batch once more (as after a lost checkpoint), under its old number
    state = spark.read.schema(D.STATE_SCHEMA).parquet(extra[1])
    n = state.agg(F.sum("n")).first()[0]
    second = log.where(half == 1)
    (D.day_state(second).withColumn("batch_id", F.lit(1).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(extra[1]))
    again = spark.read.schema(D.STATE_SCHEMA).parquet(extra[1])
    assert again.agg(F.sum("n")).first()[0] == n
    plan = again.where(F.col("day") >= F.lit("2024-01-24").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_state_report_of_empty_windows(spark):
    from flowlens.operators import drift as D
    from flowlens.plans.views import view
    s = D.day_state(view(spark, SF_SMALL, "prediction_log"))
    assert D.state_report(s, s.where("false")).first()["status"] == "no_data"
    assert D.state_report(s, s).first()["status"] == "ok"
    assert D.weighted_quantiles(s.where("false"), "value", "n", [0.5]) == []
