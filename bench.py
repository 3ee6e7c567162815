"""Time the headline queries on local[$BENCH_CPUS]; prints one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     1 = every registered query
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayledger.plans import catalog  # noqa: E402
from stayledger.session import build_session  # noqa: E402

HEADLINE = (
    "clean_bookings",
    "clean_audit",
    "engineer_all",
    "numeric_summary",
    "leakage_scan",
    "corr_matrix",
    "rollup_composition",
    "time_split",
    "stratified_kfold",
    "cv_expanding",
    "time_order",
    "target_encode_oof",
    "encode_all",
    "robust_scale",
    "binary_metrics",
    "roc_points",
    "calibration",
    "cost_curve",
    "mutual_info_binned",
    "linear_contributions",
    "score_batch",
    "lag_features",
    "backtest_naive",
    "best_price",
    "base_cancel_rate",
    "psi_numeric",
    "ks_two_sample",
    "drift_report",
    "retrain_policy",
    "stream_scored",
    "stream_last_n",
    "train_and_score",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(catalog.QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    catalog.QUERIES["demand_series"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    started = time.perf_counter()
    for name in names:
        t = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - t, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = time.perf_counter() - started

    bookings = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    out = {
        "metric": f"{len(names)} booking-analytics queries, local[{cpus}]",
        "value": round(total, 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "bookings": bookings,
    }
    if "score_batch" in seconds:
        out["scored_rows_per_sec"] = round(bookings / seconds["score_batch"])
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
