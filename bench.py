"""Time the headline queries and print one JSON line.

Each query is planned and run to a sink that discards its rows, once, after one small warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from arrears.session import build_session
from catalogue import REGISTRY

HEADLINE = [
    "certificate_totals", "certificate_detail", "taxpayer_profile", "accessibility", "taxpayer_store_v1",
    "debt_store_v1", "credit_store", "rating_summary", "collection_lists", "extract_property",
    "collection_sheet_year", "pivot_distinct", "entity_rollup", "cohort_new", "pareto_curve", "running_totals",
    "dedupe_first", "describe_by_group", "winsorize", "cumulative_new", "spearman", "rating_quantile", "join_left",
    "attach_measures",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["distinct_rows"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {seconds[name]:8.3f} s", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
