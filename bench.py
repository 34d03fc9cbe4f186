"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import re
import time

from salesloom.catalog import QUERIES
from salesloom.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
HEADLINE = [
    "a09_top_products",            # top products of the whole market
    "ru4_company_top_products",    # the same for all companies at once
    "rc01_brand_shares",           # brand shares of all companies
    "c01_compare_vs_market",       # every company against its market
    "c05_compare_products",
    "ru7_company_analytics",
    "p06_company_status",
    "rc09_root_cause_report",      # the full root-cause report of all companies
    "a18_dashboard",
    "j13_sales_with_items",
    "i03_recompute_totals",
    "s06_cms_build",
    "st04_company_product_windows",
    "st07_company_stream",
    "ru5_market_top_brands",
    "st09_company_brand_stream",
    "l01_sales_list",
    "i11_orphan_items",
]


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.python.sql.dataFrameDebugging.enabled": "false", "spark.sql.dataFrameQueryContext.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    small = re.sub(r"sf[\d.]+", "sf0.001", FOLDER)
    if os.path.isdir(small):  # compile and warm up on other, tiny data
        for name in HEADLINE:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([\d.]+)", FOLDER)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf.group(1)) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
