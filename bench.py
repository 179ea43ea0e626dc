"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every timing runs the query in full (a noop write). Derived tables that several
queries read (frame, scored frame, prepared pages) are built by the timed
``build_*`` steps first, so a query's own time is its own work.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelwright.catalog import CASES, inputs as I
from panelwright.catalog.model_cases import page_specs
from panelwright.plans.jobs import refresh_queue_job, review_queue_job
from panelwright.session import local_session
from panelwright.sources import standins

QUERIES = [
    "table_row_counts", "scan_partition_list", "build_modeling_frame", "feature_window_agg", "momentum_frame",
    "momentum_volatility_frame", "query_mix_signals", "grain_probe", "dedupe_first", "slice_profile",
    "coverage_growth", "percentile_rank_avg", "frozen_rule_score", "review_queue", "baseline_refresh_score",
    "final_rank", "capped_topn_per_group", "metric_comparison", "per_group_auc", "calibration_deciles",
    "bootstrap_metric_ci", "client_holdout_split", "group_kfold", "drift_triggers", "leakage_audit",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="bench")
    run(standins.table(spark, sf, "lineitem").groupBy("l_returnflag").count())       # JVM warm-up

    split = I.split_of("dev")
    steps = {
        "build_frame": lambda: I.frame(spark, sf),
        "build_scored": lambda: (I.scored(spark, sf), I.scored(spark, sf, "sealed")),
        "build_pages": lambda: (I.prepared(spark, sf), I.baseline(spark, sf), I.final(spark, sf)),
        "build_partitioned_fact": lambda: I.stored_fact(spark, sf),
        "review_queue_job": lambda: run(
            review_queue_job(I.fact(spark, sf, split), I.dim(spark, sf), split, visible_at=I.VISIBLE)
        ),
        "refresh_queue_job": lambda: run(refresh_queue_job(standins.page_table(spark, sf), page_specs())),
    }
    steps |= {key: (lambda key=key: run(CASES[key].query(spark, sf))) for key in QUERIES}

    times = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
