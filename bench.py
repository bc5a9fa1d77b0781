"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed in full through a ``noop`` sink (no collection to the
driver); DuckDB runs the oracle SQL of the same query for comparison.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "project_6g", "project_5g", "describe_numeric", "missing_report", "corr_matrix", "feature_summary",
    "impute_median", "winsorize", "log_transform", "standard_scale", "dedup_exact", "value_counts_topk",
    "kde", "roc_auc", "average_precision", "threshold_sweep", "metrics_by_domain", "weighted_combine",
    "batch_summary", "split_stratified", "kfold", "inject_noise", "psi", "ks_statistic", "drift_report",
    "feature_drift", "latency_p95", "hourly_trend", "request_rate", "promotion_gate", "read_logs",
    "stream_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    from flowlens.plans.registry import load_all
    from flowlens.plans.views import BASE_TABLES
    from flowlens.session import get_spark

    spark = get_spark(cpus=cpus, shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    # warm-up: JVM, parquet footers
    reg["confusion"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times, rows_dd = {}, {}
    for n in names:
        t0 = time.time()
        reg[n].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)

    duck = {}
    try:
        import duckdb
        con = duckdb.connect()
        con.execute(f"SET threads TO {cpus}")
        for t in BASE_TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        for n in names:
            sql = reg[n].oracle
            if not sql:
                continue
            t0 = time.time()
            rows_dd[n] = len(con.execute(sql).fetchall())
            duck[n] = round(time.time() - t0, 3)
    except Exception as e:  # noqa: BLE001
        duck["error"] = str(e)[:200]
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "duckdb_sec": duck}))


if __name__ == "__main__":
    main()
