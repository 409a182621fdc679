"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times; the figure is the median
wall time of planning and running it into Spark's no-op sink, which computes every column
of every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from revmart.plans.queries import QUERIES, Frames  # noqa: E402
from revmart.session import build_session  # noqa: E402

HEADLINE = (
    "latest_per_key",
    "priority_dedupe",
    "role_lookup",
    "exists_flag",
    "manager_chain",
    "change_rollup",
    "task_without_record",
    "product_classifiers",
    "legacy_registration",
    "unified_registration",
    "dim_user",
    "dim_opportunity",
    "dim_product",
    "dim_quote",
    "fct_quote",
    "dq_relationships",
    "dq_row_rules",
    "dq_unique",
    "dq_reconciliation",
    "dq_scorecard",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](Frames(spark, sf_dir)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "revmart_headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
