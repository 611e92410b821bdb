"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Each query is run to completion into a sink that
drops its rows; what a query writes on the way counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lossledger.session import local_session  # noqa: E402
from lossledger.sources.tables import work_tables  # noqa: E402
from queries.catalogue import SPARK  # noqa: E402

HEADLINE = (
    "agg_basic",
    "count_distinct_multi",
    "distinct_len_by_group",
    "star_join_role_dims",
    "interval_join_keyed",
    "asof_breakpoint_fill",
    "time_to_next_event",
    "window_value_frequency",
    "dedupe_first_per_key",
    "cumulative_to_cutoff",
    "loss_ratio_trailing",
    "peak_concurrent",
    "group_size_report",
    "premium_report",
    "accrued_to_cutoff",
    "claims_report",
    "loss_ratio_report",
    "wide_fact",
    "quantile_bucketize",
    "label_encode",
    "cluster_purity",
    "explain_topk",
    "text_embedding",
    "kmeans_fit",
    "linreg_predict",
)


def run(names: tuple[str, ...] = HEADLINE) -> dict[str, float]:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(app="lossledger-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def complete(name: str) -> None:
        with work_tables(spark):
            SPARK[name](spark, folder).write.format("noop").mode("overwrite").save()

    complete("agg_global")  # starts the executor threads and file readers
    times = {}
    for name in names:
        began = time.perf_counter()
        complete(name)
        times[name] = round(time.perf_counter() - began, 3)
    return times


if __name__ == "__main__":
    seconds = run(tuple(sys.argv[1:]) or HEADLINE)
    sf = os.path.basename(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))
