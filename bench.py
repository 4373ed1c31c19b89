"""Time the headline queries over whole tables and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8). Every
query runs to the last row into a sink that stores nothing; planning time is included.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES
from ordertide.session import build_session

HEADLINES = (
    "open_lines_latest", "latest_per_key", "latest_ties", "first_and_last", "lookup_default", "membership_flag",
    "any_rollup", "priority_rollup", "max_by_batch", "list_and_sum", "status_report", "timeline_full",
    "po_delay_summary", "stage_matrix_delay", "global_delay",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"), spark__sql__shuffle__partitions=cpus, spark__driver__memory="20g",
    )
    spark.sparkContext.setLogLevel("OFF")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    wanted = sys.argv[1:] or HEADLINES
    seconds = {}
    for name in wanted:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    result = {
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "lineitem_rows": rows,
    }
    if "timeline_full" in seconds:
        result["timeline_rows_per_second"] = round(rows / seconds["timeline_full"])
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
