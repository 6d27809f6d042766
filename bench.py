"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskframe.plans import QUERIES  # noqa: E402
from riskframe.session import build_session  # noqa: E402

HEADLINE = [
    "iv_summary",
    "woe_transform",
    "psi_score",
    "csi_report",
    "inverted_ks",
    "auc_exact",
    "roc_points",
    "quality_score",
    "dcr_orders",
    "dcr_copies",
    "dcr_embeddings",
    "smote_credit",
    "stratified_split",
    "fold_assignment",
    "kde_grid",
    "box_stats",
    "batch_scores",
    "linear_attribution",
    "retrain_decision",
    "what_if_sweep",
    "stream_psi",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "riskframe-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # One query over the smallest tables first, so that start-up is not charged to the first headline query.
    QUERIES["iv_summary"](spark, "/root/testdata/sf0.001").collect()
    times = {}
    for name in names:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
