"""Times the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local cores, BENCH_QUERIES (optional) a comma list of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from entityloom.catalog import CATALOG  # noqa: E402
from entityloom.session import local_session  # noqa: E402

HEADLINE = (
    "consolidate_orders",
    "priority_merge",
    "normalize_all",
    "dates_multi",
    "status_by_date",
    "source_scales",
    "country_list",
    "profiles_from_pages",
    "labelled_fields",
    "shred_elements",
    "links_resolved",
    "match_links",
    "clusters_greedy",
    "clusters_transitive",
    "merge_full",
    "community_figures",
    "thread_rollup",
    "fan_out_tables",
    "surrogate_keys",
    "reject_rows",
    "refresh_latest",
)


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    CATALOG[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # JVM and Python workers start once per session; that is not the cost of a query.
    seconds(spark, "scan_pages", folder)
    seconds(spark, "element_attr", folder)
    timed = {n: round(seconds(spark, n, folder), 3) for n in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
