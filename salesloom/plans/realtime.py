"""The last minutes: key figures, rate, top products, feed and ingestion health.

``as_of`` stands for the present; it defaults to the newest sale, so results can be repeated.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import buckets
from salesloom.functions.measures import or_zero, sales_measures, total
from salesloom.operators.filters import ALL, Filters, apply_filters, day_range, last_minutes, newest
from salesloom.operators.joins import items_of_matching_sales, items_with_product, lookup
from salesloom.operators.topk import top
from salesloom.plans.dashboard import sales_by_type


def _recent(sales: DataFrame, minutes: int, as_of: Any, f: Filters) -> DataFrame:
    return last_minutes(apply_filters(sales, f), minutes, newest(sales) if as_of is None else as_of)


def rt_summary(sales: DataFrame, minutes: int = 5, as_of: Any = None, f: Filters = ALL) -> DataFrame:
    sums = _recent(sales, minutes, as_of, f).agg(*sales_measures())
    return sums.select(or_zero("totalRevenue").alias("totalRevenue"), "totalSales",
                       or_zero("avgSaleAmount").alias("avgSaleAmount"))


def rt_by_type(sales: DataFrame, minutes: int = 5, as_of: Any = None, f: Filters = ALL) -> DataFrame:
    return sales_by_type(_recent(sales, minutes, as_of, f))


def rt_recent(sales: DataFrame, minutes: int = 5, as_of: Any = None, f: Filters = ALL, k: int = 10) -> DataFrame:
    rows = _recent(sales, minutes, as_of, f)
    return top(rows, ["-saleTime", "saleId"], k).select(
        "saleId", "saleTime", F.col("totalAmount").cast("double").alias("totalAmount"), "saleType",
        "companyId", "branchId")


def rt_sales_rate(sales: DataFrame, minutes: int = 10, as_of: Any = None, f: Filters = ALL) -> DataFrame:
    """Sales per minute of the clock; the rate over the whole span stands on every row."""
    recent = _recent(sales, minutes, as_of, f)
    by_minute = recent.groupBy(buckets.label("saleTime", "minute").alias("minute")).agg(
        F.count("*").alias("count"), total("totalAmount").alias("revenue"))
    whole = recent.agg(F.count("*")).scalar()
    return top(by_minute.select("minute", "count", "revenue",
                                F.round(whole / F.lit(minutes), 2).alias("salesPerMinute")), ["minute"])


def rt_top_products(items: DataFrame, sales: DataFrame, products: DataFrame, minutes: int = 5,
                    as_of: Any = None, f: Filters = ALL, k: int = 10) -> DataFrame:
    moment = newest(sales) if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    items = day_range(items, moment - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    sold = items_of_matching_sales(items, _recent(sales, minutes, as_of, f))
    sums = sold.groupBy("productId").agg(F.sum("quantity").alias("totalQuantity"),
                                         total("subtotal").alias("totalRevenue"))
    return top(items_with_product(sums, products, ["productName", "brand"]),
               ["-totalQuantity", "productId"], k)


def activity_feed(sales: DataFrame, clients: DataFrame, employees: DataFrame, f: Filters = ALL,
                  k: int = 50) -> DataFrame:
    """Latest sales with names; only the k chosen rows are joined."""
    latest = top(apply_filters(sales, f), ["-saleTime", "saleId"], k)
    named = lookup(lookup(latest, clients, "clientId", ["clientName"]), employees, "employeeId", ["employeeName"])
    return named.select("saleId", "saleTime", F.col("totalAmount").cast("double").alias("totalAmount"),
                        "saleType", "saleStatus", "companyId", "branchId", "region", "clientName",
                        "employeeName")


def ingestion_health(sales: DataFrame, as_of: Any = None) -> DataFrame:
    moment = newest(sales) if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    recent = F.col("saleTime") >= moment - F.expr("INTERVAL 1 MINUTE")
    return sales.agg(F.count("*").alias("totalSales"), F.count_if(recent).alias("recentSales"))
