"""A company against its market, against its region, over time, and product by product.

Every function answers for all companies at once; one company is a filter on the result. The market
is a roll-up of the grouped companies, joined back on its key, so no window gathers a whole sector.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions import buckets
from salesloom.functions.measures import gap, percent, ratio, total
from salesloom.operators.filters import ALL, Filters, apply_filters, completed, known
from salesloom.operators.topk import top, top_per_group

# A company is above or below average beyond this many percent.
ABOVE, BELOW = 10, -10


def _performance(diff: Column) -> Column:
    return (F.when(diff > ABOVE, "above_average").when(diff < BELOW, "below_average").otherwise("average"))


def _against(sales: DataFrame, market_keys: Sequence[str], f: Filters, names: dict[str, str]) -> DataFrame:
    done = known(apply_filters(completed(sales), f), "companyId", *market_keys)
    own = done.groupBy("companyId", *market_keys).agg(
        total("totalAmount").alias("revenue"), F.count("*").alias("salesCount"))
    market = own.groupBy(*market_keys).agg(
        total("revenue").alias("marketRevenue"), F.sum("salesCount").alias("marketSales"),
        F.count("companyId").alias("companiesCount"))
    both = (own.join(market, list(market_keys))
            .withColumn("avgSaleAmount", ratio(F.col("revenue"), F.col("salesCount")))
            .withColumn("marketAvgSale", ratio(F.col("marketRevenue"), F.col("marketSales"))))
    vs_average = gap(F.col("revenue"), ratio(F.col("marketRevenue"), F.col("companiesCount")))
    return both.select(
        "companyId", *market_keys, "revenue", "salesCount", "avgSaleAmount",
        F.col("marketRevenue").alias("totalRevenue"), F.col("marketSales").alias("totalSales"),
        "marketAvgSale", "companiesCount",
        F.round(percent(F.col("revenue"), F.col("marketRevenue")), 2).alias(names["share"]),
        F.round(vs_average, 2).alias(names["average"]),
        F.round(gap(F.col("avgSaleAmount"), F.col("marketAvgSale")), 2).alias(names["sale"]),
        _performance(vs_average).alias("performance"))


def compare_vs_market(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    """The market of a sector includes the company itself."""
    return _against(sales, ["sector"], f, {
        "share": "marketShare", "average": "revenueVsMarketAvg", "sale": "avgSaleVsMarket"})


def compare_vs_region(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    return _against(sales, ["sector", "region"], f, {
        "share": "regionShare", "average": "revenueVsRegionAvg", "sale": "avgSaleVsRegion"})


def company_trend(sales: DataFrame, period: str = "daily", f: Filters = ALL) -> DataFrame:
    rows = apply_filters(completed(sales), f).withColumn("bucket", buckets.label("saleTime", period))
    sums = rows.groupBy("companyId", "sector", "bucket").agg(
        total("totalAmount").alias("revenue"), F.count("*").alias("salesCount"))
    return top(sums, ["companyId", "sector", "bucket"])


def market_trend(sales: DataFrame, period: str = "daily", f: Filters = ALL) -> DataFrame:
    """Market per period with the average over the companies that sold in it."""
    by_company = company_trend(sales, period, f)
    sums = by_company.groupBy("sector", "bucket").agg(
        total("revenue").alias("revenue"), F.sum("salesCount").alias("salesCount"),
        F.count("companyId").alias("companies"))
    return top(sums.select("sector", "bucket", "revenue", "salesCount",
                           ratio(F.col("revenue"), F.col("companies")).alias("avgRevenue")),
               ["sector", "bucket"])


def compare_products(company_products: DataFrame, market_products: DataFrame, k: int = 10,
                     market_revenue: DataFrame | None = None) -> DataFrame:
    """Products of each company next to those of its market, by name (else id), first k by market revenue.

    Each company meets the first k products of its market and those that tie with the last of them, with 0
    where it does not sell one; its own revenue decides between ties. Products that the market does not list have
    no market revenue and can only follow where fewer than k products have any.

    The market's percentages are of ``market_revenue`` (sector, marketRevenue), its whole revenue; where that is not
    known or 0, of the sum of its products.
    """
    name = F.coalesce("productName", F.col("productId").cast("string")).alias("productName")
    pair, product = ["companyId", "sector"], ["companyId", "sector", "productName"]
    own = company_products.select(*pair, name, F.col("totalRevenue").alias("revenue"))
    own_total = own.groupBy(*pair).agg(total("revenue").alias("companyTotal"))
    market = market_products.select("sector", name, F.col("totalRevenue").alias("revenue")) \
        .groupBy("sector", "productName").agg(total("revenue").alias("marketRevenue"))
    market_total = market.groupBy("sector").agg(total("marketRevenue").alias("marketTotal"))
    if market_revenue is not None:
        whole = market_revenue.select("sector", F.nullif(F.col("marketRevenue"), F.lit(0.0)).alias("whole"))
        market_total = market_total.join(whole, "sector", "left").select(
            "sector", F.coalesce("whole", "marketTotal").alias("marketTotal"))
    leaders = market.withColumn("place", F.rank().over(
        Window.partitionBy("sector").orderBy(F.desc("marketRevenue")))).filter(F.col("place") <= k).drop("place")
    leading = leaders.select("sector", "productName")

    sold = own.join(leading, ["sector", "productName"]).groupBy(*product).agg(total("revenue").alias("companyRevenue"))
    listed = own_total.join(leaders, "sector").join(sold, product, "left").fillna({"companyRevenue": 0.0})
    full = leaders.filter("marketRevenue > 0").groupBy("sector").count().filter(F.col("count") >= k)
    further = (own.join(full, "sector", "left_anti").join(leading, ["sector", "productName"], "left_anti")
               .groupBy(*product).agg(total("revenue").alias("companyRevenue"))
               .withColumn("marketRevenue", F.lit(0.0)).join(own_total, pair))
    rows = top_per_group(listed.unionByName(further), pair,
                         ["-marketRevenue", "-companyRevenue", "productName"], k)
    return rows.join(market_total, "sector").select(
        *pair, "rank", "productName", "marketRevenue",
        percent(F.col("marketRevenue"), F.col("marketTotal")).alias("marketPercentage"), "companyRevenue",
        percent(F.col("companyRevenue"), F.col("companyTotal")).alias("companyPercentage"))
