"""PSI / KS / drift report properties."""
from pyspark.sql import functions as F

from flowlens.operators import drift as D
from flowlens.plans.views import view
from tests.conftest import SF_SMALL


def _log(spark):
    return view(spark, SF_SMALL, "prediction_log")


def test_psi_identical_is_zero(spark):
    d = _log(spark)
    assert D.psi(d, d, "attack_rate").first()["psi"] < 1e-12


def test_psi_shift_is_large(spark):
    d = _log(spark)
    shifted = d.withColumn("attack_rate", F.col("attack_rate") + 0.5)
    assert D.psi(d, shifted, "attack_rate").first()["psi"] > 0.2


def test_psi_empty_side_is_zero(spark):
    d = _log(spark)
    assert D.psi(d, d.where("false"), "attack_rate").first()["psi"] == 0.0


def test_ks_identical_and_shifted(spark):
    d = _log(spark)
    same = D.ks_statistic(d, d, "mean_probability").first()
    assert same["ks_statistic"] == 0.0
    far = D.ks_statistic(d, d.withColumn("mean_probability", F.col("mean_probability") + 2.0), "mean_probability")
    assert far.first()["ks_statistic"] == 1.0


def test_report_statuses(spark):
    d = _log(spark)
    ok = D.drift_report(d, d).first()
    assert ok["status"] == "ok" and ok["alerts"] == []
    drift = D.drift_report(d, d.withColumn("attack_rate", F.col("attack_rate") + 0.5)).first()
    assert drift["status"] == "drift_detected" and len(drift["alerts"]) >= 1
    empty = D.drift_report(d, d.where("false")).first()
    assert empty["status"] == "no_data"
