"""Time ranges over facts stored by day read the files of those days only."""

import re

import pytest
from pyspark.sql import functions as F

from salesloom import model, session
from salesloom.catalog.bindings import Tables
from salesloom.operators import filters
from salesloom.operators.filters import Filters
from salesloom.operators.joins import items_with_sale
from salesloom.plans import dashboard, realtime
from salesloom.sources.tables import save_facts


@pytest.fixture(scope="module")
def stored(spark):
    """Event sales and items by day and bucket, next to the same rows as they are."""
    b, path = Tables(spark, "/root/testdata/sf0.001"), session.work_folder(spark, "days")
    for name, df in (("days_sales", b.ev_sales), ("days_items", b.ev_items)):
        save_facts(df, name, 2, day=model.DAY, path=f"{path}/{name}")
    yield b, spark.table("days_sales"), spark.table("days_items").drop("saleTime")
    for name in ("days_sales", "days_items"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def filters_of(df):
    """Partition filters of the scans of the plan that ran, and the partitions that they read."""
    df.collect()
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"PartitionFilters: \[(.+)\]", plan)


def plain(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_ranges_reach_the_scan(stored):
    b, sales, items = stored
    low, high = b.ev_sales.agg(F.min("saleTime"), F.max("saleTime")).first()
    middle = low + (high - low) / 2
    f = Filters(start=str(middle), end=str(middle + (high - low) / 8))
    cases = {
        "a08": lambda s, i: dashboard.sales_trends(s, "day", f),
        "a09": lambda s, i: dashboard.top_products(i, s, b.products, f),
        "r01": lambda s, i: realtime.rt_summary(s, 600),
        "r01 at": lambda s, i: realtime.rt_summary(s, 600, str(middle)),
        "r05": lambda s, i: realtime.rt_top_products(i, s, b.products, 600),
        "j04": lambda s, i: items_with_sale(filters.day_range(i, f.start, f.end), filters.apply_filters(s, f),
                                            ["companyId", "saleTime"]).drop(model.DAY),
        "lookback": lambda s, i: filters.lookback(s, "week").drop(model.DAY),
    }
    for name, plan in cases.items():
        found = plan(sales, items)
        wide = plan(b.ev_sales, b.ev_items.drop("saleTime"))
        assert plain(found.select(*wide.columns)) == plain(wide), name
        scans = filters_of(found)
        assert scans and all(model.DAY in s for s in scans), name
        # items are cut like their sales: as many cut scans as there are fact tables
        assert len(scans) >= (2 if name in ("a09", "r05", "j04") else 1), name


def test_only_days_in_range_are_read(stored):
    _, sales, _ = stored
    days = sales.agg(F.count_distinct(model.DAY)).first()[0]
    last = filters.last_minutes(sales, 60)
    last.collect()
    text = last._jdf.queryExecution().executedPlan().toString()
    assert model.DAY in text
    files = last.select(F.input_file_name()).distinct().count()
    assert days > 5 and files <= 4  # at most two days of two buckets


def test_rows_of_a_bucket_are_sorted_by_time(stored):
    _, sales, _ = stored
    rows = sales.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "saleTime").toPandas()
    for _, own in rows.sort_values("i").groupby("f"):
        assert own["saleTime"].is_monotonic_increasing
