"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pactloom.parity import CASES  # noqa: E402
from pactloom.session import build_session  # noqa: E402

HEADLINE = (
    "latest_per_key",
    "staging_build",
    "safe_cast_project",
    "quality_counts",
    "quality_counts_by",
    "assertion_report",
    "contract_to_assertions",
    "unique_key_check",
    "incremental_filter",
    "upsert_by_key",
    "incremental_append",
    "incremental_merge",
    "archive_idempotent",
    "partition_retention",
    "append_raw",
    "scan_csv",
    "scan_ndjson",
    "route_files",
    "registry_routing",
    "schema_diff",
    "schema_diff_rows",
    "drift_outcome",
    "classify_drift_event",
    "profile_columns",
    "profile_contract",
    "category_metric",
    "last_n_turns",
    "fn_collapse_whitespace",
    "file_arrival_stream",
    "dedup_events",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the JVM's code paths; not counted.
    CASES["global_max"].build(spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        CASES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline queries, wall time", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps({**line, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
