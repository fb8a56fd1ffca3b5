"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from gristmill.queries import all_queries
from gristmill.session import build_session

HEADLINE = [
    "validate_valid",
    "validate_errors",
    "field_coverage",
    "harvest_trim",
    "tfidf_weights",
    "near_dup_pairs",
    "dedupe_kept",
    "distinct_n",
    "vocabulary_size",
    "mean_pairwise_distance",
    "diversity_report",
    "label_balance",
    "judge_means",
    "synth_orders",
    "recombine_shuffle",
    "per_parent_children",
    "scenario_overlay",
    "fk_match",
    "copy_field",
    "fk_violations",
    "pk_check",
    "marketplace_items",
    "entity_quality",
    "prompt_batches",
    "prompt_routing",
    "evaluate_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cores}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cores,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
