"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the cores. The derived input tables are written
first and timed apart. Each query runs twice, its rows going to a sink that drops them; the
second run is the value, the first is listed as cold.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sqlsieve.plans.queries import REGISTRY  # noqa: E402
from sqlsieve.plans.tables import Tables  # noqa: E402
from sqlsieve.session import local_session  # noqa: E402

HEADLINES = [
    "quality_funnel", "kept_files", "feature_tags", "all_chunks", "prompt_table", "ranked_files",
    "dataset_records", "repo_records", "answer_outcomes", "top_pairs", "train_text",
    "conversation_turns", "size_line_stats", "shard_assignment", "v2_top_products",
    "v5_running_total", "v7_days_to_ship", "v9_recent_orders",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), memory="16g", app="bench")
    tables = Tables(spark, folder)

    def seconds(run) -> float:
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    inputs = {
        name: seconds(getattr(tables, name))
        for name in ("sql_files", "index", "blobs", "blob_store", "corpus_records", "prompts", "responses")
    }
    inputs["rich_files"] = seconds(lambda: tables.sql_files(rich=True))
    cold, warm = {}, {}
    for name in HEADLINES:
        run = REGISTRY[name].run
        cold[name] = seconds(lambda: run(tables))
        warm[name] = seconds(lambda: run(tables))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "inputs": inputs,
                "n_files": tables.sql_files().count(),
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
