"""Labelled anomaly injection: fraction, determinism, no-op, input untouched."""
from pyspark.sql import functions as F

from flowlens.operators import split as E
from flowlens.plans.q_split import projected_labelled_6g
from tests.conftest import SF_SMALL

FEATS = ["u_duration", "u_pkt_rate", "u_byte_rate", "u_syn", "u_rst", "u_pkt_ratio", "u_fwd_pkts"]


def test_injection_fraction_and_determinism(spark):
    df = projected_labelled_6g(spark, SF_SMALL).select("flow_id", "Label", *FEATS)
    n = df.count()
    a = E.inject_noise(df, "flow_id", "Label", FEATS, 0.15, seed=7)
    b = E.inject_noise(df.repartition(5), "flow_id", "Label", FEATS, 0.15, seed=7)
    assert a.where("injected = 1").count() == int(0.15 * n)
    assert a.where("Label = 1").count() >= int(0.15 * n)
    ka = sorted(r[0] for r in a.where("injected = 1").select("flow_id").collect())
    kb = sorted(r[0] for r in b.where("injected = 1").select("flow_id").collect())
    assert ka == kb
    assert df.where("Label = 1").count() == 0  # input untouched


def test_fraction_zero_is_noop(spark):
    df = projected_labelled_6g(spark, SF_SMALL).select("flow_id", "Label", *FEATS)
    out = E.inject_noise(df, "flow_id", "Label", FEATS, 0.0)
    diff = out.select("flow_id", "Label", *FEATS).exceptAll(df)
    assert diff.count() == 0
