"""A representative subset of registered queries against their DuckDB oracle at sf0.001
(the full catalogue is checked by tools/oracle_check.py at sf0.01)."""
import pytest

from flowlens.plans.registry import load_all
from tools.oracle_check import digest
from tests.conftest import SF_SMALL

SUBSET = [
    "project_6g", "project_5g", "describe_numeric", "describe_categorical", "missing_report", "histogram_by_class",
    "outlier_report", "corr_matrix", "vif", "port_onehot_topn", "impute_median", "winsorize", "log_report",
    "standard_scale", "drop_correlated", "roc_auc", "average_precision", "best_threshold", "threshold_sweep",
    "class_report", "weighted_combine", "ablation", "split_three_way", "inject_structured", "psi", "ks_statistic",
    "drift_report", "promotion_gate", "latency_p95", "hourly_trend", "read_logs", "row_mse",
]


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, duck, name):
    spec = load_all()[name]
    sdf = spec.fn(spark, SF_SMALL)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(spec.oracle)
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(c.lower() for c in scols) == sorted(c.lower() for c in ocols)
    assert len(srows) == len(orows)
    assert digest(scols, srows)[0] == digest(ocols, orows)[0]


def test_every_query_is_registered_with_a_docstring():
    reg = load_all()
    assert len(reg) > 140
    for name, spec in reg.items():
        assert spec.fn.__doc__, name
