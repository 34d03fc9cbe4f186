"""Problems of companies and regions, found for all of them in one job from the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import texts
from salesloom.functions.measures import gap, mean, ratio, total
from salesloom.functions.names import UNKNOWN_NAME
from salesloom.functions.texts import say
from salesloom.operators.filters import completed, has_employee, known
from salesloom.operators.topk import top_per_group

# Thresholds of the problem rules, in percent.
HIGH, MEDIUM = 20, 10
LOW_SALE_SHARE = 0.8
LOW_COUNT = -20
LOW_REGION = -20
NAMED = 3  # products or brands that the advice names


def with_sales(df: DataFrame, company: DataFrame) -> DataFrame:
    """Gate: only companies and sectors with completed sales are examined."""
    return df.join(company.select("companyId", "sector"), ["companyId", "sector"], "left_semi")


def company_gaps(company: DataFrame, market: DataFrame) -> DataFrame:
    """Each company next to the average company of its sector.

    A missing company count counts as one company, a count of 0 gives an average of 0.
    """
    count = F.coalesce("totalCompanies", F.lit(1))
    df = company.join(market, "sector").select(
        "companyId", "sector", "revenue", "salesCount", "avgSaleAmount", "marketRevenue",
        "marketSalesCount", "marketAvgSale", count.alias("totalCompanies"),
        ratio(F.col("marketRevenue"), count).alias("marketAvg"),
        ratio(F.col("marketSalesCount"), count).alias("marketAvgSalesCount"))
    return df.select(
        "*", gap(F.col("revenue"), F.col("marketAvg")).alias("revenueDiff"),
        gap(F.col("avgSaleAmount"), F.col("marketAvgSale")).alias("avgSaleDiff"),
        gap(F.col("salesCount"), F.col("marketAvgSalesCount")).alias("salesCountDiff"))


def revenue_problem() -> Column:
    return (F.col("revenue") > 0) & (F.col("marketAvg") > 0) & (F.col("revenue") < F.col("marketAvg"))


def revenue_severity() -> Column:
    diff = F.abs("revenueDiff")
    return F.when(diff >= HIGH, "high").when(diff >= MEDIUM, "medium").otherwise("low")


def employee_stats(sales: DataFrame) -> DataFrame:
    """Average number of sales per employee and number of employees, per company and sector."""
    per_employee = has_employee(completed(sales)).groupBy("companyId", "sector", "employeeId").agg(
        F.count("*").alias("salesCount"))
    return per_employee.groupBy("companyId", "sector").agg(
        F.avg("salesCount").alias("avgSalesPerEmployee"), F.count("*").alias("totalEmployees"))


def _problem(kind: str, severity: Column, current: str, market: str, difference: Column,
             description: Column, recommendation: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"), severity.alias("severity"), F.col(current).cast("double").alias("currentValue"),
        F.col(market).cast("double").alias("marketValue"), F.round(difference, 1).alias("difference"),
        description.alias("description"), recommendation.alias("recommendation"))


def best_sellers(products: DataFrame, brands: DataFrame | None = None) -> DataFrame:
    """topProducts and topBrands: the first names by revenue of each company and sector, for the advice."""
    pair = ["companyId", "sector"]

    def first(df: DataFrame, name: Column, revenue: str, alias: str) -> DataFrame:
        ranked = top_per_group(df.select(*pair, name.alias("name"), revenue), pair, ["-" + revenue, "name"], NAMED)
        grouped = ranked.groupBy(*pair).agg(F.sort_array(F.collect_list(F.struct("rank", "name"))).alias("names"))
        return grouped.select(*pair, F.transform("names", lambda e: e["name"]).alias(alias))

    found = first(products, F.coalesce("productName", F.lit(UNKNOWN_NAME)), "totalRevenue", "topProducts")
    if brands is None:
        return found.withColumn("topBrands", F.array().cast("array<string>"))
    return found.join(first(brands, F.coalesce("brand", F.lit(UNKNOWN_NAME)), "revenue", "topBrands"), pair, "full")


def _with_problems(gaps: DataFrame, staff: DataFrame | None, sellers: DataFrame | None = None) -> DataFrame:
    """Gap rows with the array of problems found (at most one per rule).

    The advice names the best selling products (``best_sellers``), else brands, else neither.
    """
    nothing = F.array().cast("array<string>")
    if sellers is None:
        gaps = gaps.withColumns({"topProducts": nothing, "topBrands": nothing})
    else:
        gaps = gaps.join(sellers, ["companyId", "sector"], "left").withColumns(
            {c: F.coalesce(c, nothing) for c in ("topProducts", "topBrands")})
    named = F.size("topProducts") > 0
    products, brands = F.concat_ws(", ", "topProducts"), F.concat_ws(", ", "topBrands")
    if staff is None:
        gaps = gaps.withColumn("avgSalesPerEmployee", F.lit(0.0)).withColumn("totalEmployees", F.lit(0))
    else:
        gaps = gaps.join(staff, ["companyId", "sector"], "left").fillna(
            {"avgSalesPerEmployee": 0.0, "totalEmployees": 0})
    own, average = F.col("avgSaleAmount"), F.col("marketAvgSale")
    sale_diff = F.when(average > 0, (1 - own / average) * 100).otherwise(F.lit(0.0))
    count_average = F.round("marketAvgSalesCount").cast("bigint")
    low_revenue = _problem(
        "low_revenue", revenue_severity(), "revenue", "marketAvg", F.abs("revenueDiff"),
        say(texts.LOW_REVENUE, F.abs("revenueDiff"), texts.locale_number(F.col("revenue")),
            texts.locale_number(F.col("marketAvg"))),
        F.when(named, say(texts.LOW_REVENUE_PRODUCTS, products))
        .when(F.size("topBrands") > 0, say(texts.LOW_REVENUE_BRANDS, brands)).otherwise(texts.LOW_REVENUE_ADVICE))
    low_sale = _problem(
        "low_avg_sale", F.lit("medium"), "avgSaleAmount", "marketAvgSale", sale_diff,
        say(texts.LOW_AVG_SALE, sale_diff, own, average),
        F.when(named, say(texts.LOW_AVG_SALE_PRODUCTS, own, average, products))
        .otherwise(say(texts.LOW_AVG_SALE_ADVICE, own, average)))
    staffed = (F.col("totalEmployees") > 0) & (F.col("avgSalesPerEmployee") > 0)
    low_count = _problem(
        "low_sales_count", F.lit("high"), "salesCount", "marketAvgSalesCount", F.abs("salesCountDiff"),
        say(texts.LOW_COUNT, F.abs("salesCountDiff"), F.col("salesCount"), count_average),
        F.concat(say(texts.LOW_COUNT_ADVICE, F.col("salesCount"), count_average),
                 F.when(staffed, say(texts.LOW_COUNT_STAFF, F.col("avgSalesPerEmployee")))
                 .otherwise(texts.LOW_COUNT_NO_STAFF)))
    return gaps.withColumn("problems", F.array_compact(F.array(
        F.when(revenue_problem(), low_revenue),
        F.when(own < average * LOW_SALE_SHARE, low_sale),
        F.when(F.col("salesCountDiff") < LOW_COUNT, low_count))))


def detect_problems(company: DataFrame, market: DataFrame, staff: DataFrame | None = None,
                    sellers: DataFrame | None = None) -> DataFrame:
    """One row per problem of a company in a sector."""
    rows = _with_problems(company_gaps(company, market), staff, sellers)
    return rows.select("companyId", "sector", F.explode("problems").alias("p")).select(
        "companyId", "sector", "p.*")


def company_status(company: DataFrame, market: DataFrame, staff: DataFrame | None = None) -> DataFrame:
    """healthy, critical (any high problem) or warning, with the figures compared."""
    rows = _with_problems(company_gaps(company, market), staff)
    count = F.size("problems")
    high = F.exists("problems", lambda p: p["severity"] == "high")
    return rows.select(
        "companyId", "sector", "revenue", "salesCount", "avgSaleAmount",
        F.col("marketAvg").alias("marketRevenue"),
        F.round("marketAvgSalesCount").cast("bigint").alias("marketSalesCount"), "marketAvgSale",
        count.alias("problemsCount"),
        F.when(count == 0, "healthy").when(high, "critical").otherwise("warning").alias("overallStatus"))


def region_gaps(sales: DataFrame) -> DataFrame:
    """Each region of a sector next to the mean of the other regions.

    The others are the sector total minus the region's own share, from grouped rows.
    """
    own = known(completed(sales), "region", "sector").groupBy("sector", "region").agg(
        total("totalAmount").alias("revenue"), F.count("*").alias("salesCount"),
        mean("totalAmount").alias("avgSaleAmount"), F.count_distinct("companyId").alias("companiesCount"))
    sector = own.groupBy("sector").agg(total("revenue").alias("allRevenue"),
                                       F.sum("salesCount").alias("allSales"),
                                       F.count("region").alias("allRegions"))
    others, sold = F.col("allRegions") - 1, F.col("allSales") - F.col("salesCount")
    rest = F.col("allRevenue") - F.col("revenue")
    rows = own.join(sector, "sector").select(
        "sector", "region", "revenue", "salesCount", "avgSaleAmount", "companiesCount",
        ratio(rest, others).alias("marketRevenue"),
        F.round(ratio(sold, others)).cast("bigint").alias("marketSalesCount"),
        ratio(rest, sold).alias("marketAvgSale"))
    return rows.withColumn("revenueDiff", gap(F.col("revenue"), F.col("marketRevenue")))


def detect_region_problems(sales: DataFrame) -> DataFrame:
    low = region_gaps(sales).filter(F.col("revenueDiff") < LOW_REGION)
    return low.select(
        "sector", "region", F.lit("low_region_performance").alias("type"), F.lit("high").alias("severity"),
        "revenue", "marketRevenue", F.round(F.abs("revenueDiff"), 1).alias("difference"),
        say(texts.LOW_REGION, F.abs("revenueDiff")).alias("description"),
        F.lit(texts.LOW_REGION_ADVICE).alias("recommendation"))
