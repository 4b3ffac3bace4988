"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. The tracking
feeds are first derived from its tables and written, and the facts published,
as a warehouse would hold them; that time is given apart as ``publish_facts``.
Fact queries read the feeds, analyses the published facts. Every query is run once to
warm up and then three times; the median counts. Results go to a sink that
takes all rows and writes nothing. Some more queries are run once each and told
apart, as ``more``.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from catalog.spark_queries import QUERIES, publish_facts
from shoptrail.session import local_session

HEADLINE = (
    "session_fct", "pageview_fct", "product_view_fct", "add_to_cart_fct", "purchase_fct", "user_dim",
    "conversion_funnel_fct", "rage_click_fct", "js_error_fct", "user_interaction_fct",
    "product_performance", "friction_by_score", "source_comparison", "kpi_sheet",
    "page_flow", "one_row_per_key", "tests_generic",
)
# Run once each after the others, not part of the total: joins through time, whole-table operators, a merge, a stream.
MORE = (
    "last_touch_before_purchase", "friction_per_page_view", "sessions_by_gap", "rfm_quintiles", "funnel_cube",
    "rolling_activity", "merge_by_key", "late_rows_with_lookback", "stream_sessions_by_gap",
)


def once(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    publish_facts(spark, folder)
    stored = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in HEADLINE:
        once(spark, folder, name)
        seconds[name] = round(statistics.median(once(spark, folder, name) for _ in range(3)), 3)
    more = {name: round(once(spark, folder, name), 3) for name in MORE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "publish_facts": stored,
        "more": more,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
