"""Root causes of weak results, for all companies and sectors in one job.

Inputs are the small result tables. Each rule gives rows (companyId, sector, type, severity,
description, recommendation) plus its own figures; the report is their union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import names, texts
from salesloom.functions.measures import percent, ratio, total
from salesloom.functions.texts import listed, say
from salesloom.operators.topk import top_per_group
from salesloom.plans.problems import company_gaps, revenue_problem, revenue_severity

# Thresholds of the root-cause rules, in percent or percentage points.
BRAND_GAP, BRAND_HIGH = 15, 25
COVERAGE_GAP, COVERAGE_HIGH = 20, 30
PRICE_WITH_PROBLEM, PRICE_ALONE = 15, 20
EMPLOYEE_PROBLEM, EMPLOYEE_HIGH = 50, 30
CATEGORY_GAP, CATEGORY_HIGH = 20, 25
FACTOR_GAP, FACTOR_REVENUE_GAP = -10, -20
COMPANY_BRANDS, MARKET_BRANDS, LISTED = 5, 10, 5
COMPANY_EMPLOYEES = 10

CAUSE = ["companyId", "sector", "type", "severity", "description", "recommendation"]


def gaps(company: DataFrame, market: DataFrame) -> DataFrame:
    """Company figures with a flag for the revenue problem, which tightens other rules."""
    return company_gaps(company.filter(F.col("revenue") > 0), market).withColumn(
        "hasRevenueProblem", revenue_problem())


LEADERS = 3


def _leaders(df: DataFrame, keys: Sequence[str], name: str, revenue: str, side: str) -> DataFrame:
    """Per group: first entry, its revenue, names and revenue of the first three, which are all the array holds."""
    ranked = top_per_group(df, keys, ["-" + revenue, name], LEADERS)
    entry = F.struct("rank", F.col(name).alias("name"), F.col(revenue).alias("revenue"))
    grouped = ranked.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("first"))
    return grouped.select(
        *keys, F.element_at("first", 1)["name"].alias(side + "Top"),
        F.element_at("first", 1)["revenue"].alias(side + "TopRevenue"),
        F.transform("first", lambda e: e["name"]).alias(side + "Top3"),
        F.aggregate("first", F.lit(0.0), lambda s, e: s + e["revenue"]).alias(side + "Top3Revenue"))


def brand_shares(base: DataFrame, company_brands: DataFrame, market_brands: DataFrame) -> DataFrame:
    """First 5 brands of each company and first 10 of its market with their percent of all revenue."""
    own = top_per_group(company_brands, ["companyId", "sector"], ["-revenue", "brand"], COMPANY_BRANDS)
    own = own.join(base.select("companyId", "sector", F.col("revenue").alias("whole")), ["companyId", "sector"])
    market = top_per_group(market_brands, ["sector"], ["-totalRevenue", "brand"], MARKET_BRANDS)
    market = market.join(base.select("companyId", "sector", F.col("marketRevenue").alias("whole")), "sector")
    return own.select("companyId", "sector", F.lit("company").alias("side"), "rank", "brand", "revenue",
                      percent(F.col("revenue"), F.col("whole")).alias("percentage")).unionByName(
        market.select("companyId", "sector", F.lit("market").alias("side"), "rank", "brand",
                      F.col("totalRevenue").alias("revenue"),
                      percent(F.col("totalRevenue"), F.col("whole")).alias("percentage")))


def root_cause_revenue(base: DataFrame) -> DataFrame:
    factors = F.array_compact(F.array(
        F.when(F.col("avgSaleDiff") < FACTOR_GAP, say(texts.FACTOR_AVG_SALE, F.abs("avgSaleDiff"))),
        F.when(F.col("salesCountDiff") < FACTOR_GAP, say(texts.FACTOR_COUNT, F.abs("salesCountDiff"))),
        F.when(F.col("revenueDiff") < FACTOR_REVENUE_GAP, F.lit(texts.FACTOR_REVENUE))))
    kinds = F.array_compact(F.array(
        F.when(F.col("avgSaleDiff") < FACTOR_GAP, F.lit("avg_sale")),
        F.when(F.col("salesCountDiff") < FACTOR_GAP, F.lit("sales_count")),
        F.when(F.col("revenueDiff") < FACTOR_REVENUE_GAP, F.lit("revenue"))))
    diff = F.abs("revenueDiff")
    rows = base.filter("hasRevenueProblem").withColumn("factorTexts", factors)
    return rows.select(
        "companyId", "sector", F.lit("low_revenue").alias("type"), revenue_severity().alias("severity"),
        say(texts.LOW_REVENUE, diff, texts.locale_number(F.col("revenue")),
            texts.locale_number(F.round("marketAvg"))).alias("description"),
        F.concat(say(texts.REVENUE_CAUSE_ADVICE, diff),
                 F.when(F.size("factorTexts") > 0,
                        say(texts.REVENUE_CAUSE_FACTORS, F.concat_ws(", ", "factorTexts"))).otherwise(""),
                 F.lit(texts.REVENUE_CAUSE_ACTIONS)).alias("recommendation"),
        "revenue", F.round("marketAvg").alias("marketAverage"), "revenueDiff", "salesCount",
        F.round("marketAvgSalesCount").cast("bigint").alias("marketAvgSalesCount"),
        "avgSaleAmount", "marketAvgSale", F.concat_ws(",", kinds).alias("factors"))


def root_cause_brand(base: DataFrame, company_brands: DataFrame, market_brands: DataFrame) -> DataFrame:
    """A weak top brand, or first three brands that neither match nor cover the market's."""
    own = _leaders(company_brands, ["companyId", "sector"], "brand", "revenue", "own")
    market = _leaders(market_brands, ["sector"], "brand", "totalRevenue", "market")
    rows = (base.filter((F.col("revenue") > 0) & (F.col("marketRevenue") > 0))
            .join(own, ["companyId", "sector"]).join(market, "sector")
            .withColumn("ownShare", percent(F.col("ownTopRevenue"), F.col("revenue")))
            .withColumn("marketShare", percent(F.col("marketTopRevenue"), F.col("marketRevenue")))
            .withColumn("ownCoverage", percent(F.col("ownTop3Revenue"), F.col("revenue")))
            .withColumn("marketCoverage", percent(F.col("marketTop3Revenue"), F.col("marketRevenue")))
            .withColumn("shareGap", F.col("ownShare") - F.col("marketShare"))
            .withColumn("coverageGap", F.col("marketCoverage") - F.col("ownCoverage"))
            .withColumn("sameBrand", F.col("ownTop") == F.col("marketTop"))
            .withColumn("matches", F.size(F.array_intersect("marketTop3", "ownTop3")))
            .withColumn("missing", F.array_except("marketTop3", "ownTop3")))
    weak = F.col("shareGap") < -BRAND_GAP
    uncovered = (F.col("matches") < 2) & (F.col("coverageGap") > COVERAGE_GAP)
    severity = (F.when(weak, F.when(F.abs("shareGap") > BRAND_HIGH, "high").otherwise("medium"))
                .otherwise(F.when(F.col("coverageGap") > COVERAGE_HIGH, "high").otherwise("medium")))
    gap_size, some = F.abs("shareGap"), F.size("missing") > 0
    description = (
        F.when(weak & ~F.col("sameBrand"),
               say(texts.BRAND_DIFFERS, F.col("ownTop"), F.col("ownShare"), F.col("marketTop"),
                   F.col("marketShare"), gap_size))
        .when(weak, say(texts.BRAND_WEAK, F.col("ownTop"), F.col("ownShare"), F.col("marketShare"), gap_size))
        .otherwise(say(texts.BRAND_COVERAGE, F.col("ownCoverage"), F.col("marketCoverage"), F.col("matches"))))
    advice = (
        F.when(weak & ~F.col("sameBrand"), F.concat(
            say(texts.BRAND_DIFFERS_ADVICE, F.col("marketTop")),
            F.when(some, say(texts.BRAND_ALSO, listed(F.col("missing")))).otherwise(""),
            say(texts.BRAND_SHARE, F.col("marketCoverage"))))
        .when(weak, say(texts.BRAND_WEAK_ADVICE, F.col("ownTop")))
        .otherwise(F.concat(
            F.lit(texts.BRAND_COVERAGE_ADVICE),
            F.when(some, say(texts.BRAND_ADDING, listed(F.col("missing")))).otherwise(""),
            F.lit(texts.BRAND_COVERAGE_END))))
    return rows.filter(weak | uncovered).select(
        "companyId", "sector", F.lit("brand_issue").alias("type"), severity.alias("severity"),
        description.alias("description"), advice.alias("recommendation"),
        F.col("ownTop").alias("companyTopBrand"), F.col("marketTop").alias("marketTopBrand"),
        F.col("ownTopRevenue").alias("companyBrandRevenue"), F.col("marketTopRevenue").alias("marketBrandRevenue"),
        F.col("ownShare").alias("companyBrandPercentage"), F.col("marketShare").alias("marketBrandPercentage"),
        "coverageGap", F.concat_ws(",", "ownTop3").alias("top3CompanyBrands"),
        F.concat_ws(",", "marketTop3").alias("top3MarketBrands"),
        F.concat_ws(",", "missing").alias("missingBrands"), "sameBrand")


def root_cause_price(base: DataFrame) -> DataFrame:
    """The average sale stands in for the price level; a revenue problem lowers the threshold."""
    threshold = F.when(F.col("hasRevenueProblem"), PRICE_WITH_PROBLEM).otherwise(PRICE_ALONE)
    diff, own, market = F.col("avgSaleDiff"), F.col("avgSaleAmount"), F.col("marketAvgSale")
    high = diff > threshold
    rows = base.filter((market > 0) & (high | (diff < -threshold)))
    return rows.select(
        "companyId", "sector", F.lit("pricing_issue").alias("type"),
        F.when(high, "high").otherwise("medium").alias("severity"),
        F.when(high, say(texts.PRICE_HIGH, diff, own, market))
        .otherwise(say(texts.PRICE_LOW, F.abs(diff), own, market)).alias("description"),
        F.when(high, say(texts.PRICE_HIGH_ADVICE, own, diff, market))
        .otherwise(say(texts.PRICE_LOW_ADVICE, own, F.abs(diff), market)).alias("recommendation"),
        own.alias("companyAvgPrice"), market.alias("marketAvgPrice"), diff.alias("priceDifference"))


def employee_market_avg(market: DataFrame, market_employees: DataFrame) -> DataFrame:
    """Sales and revenue per employee of each sector."""
    return market.join(market_employees.select("sector", "totalSales", "totalEmployees"), "sector").select(
        "sector", ratio(F.col("totalSales"), F.col("totalEmployees")).alias("avgSalesPerEmployee"),
        ratio(F.col("marketRevenue"), F.col("totalEmployees")).alias("avgRevenuePerEmployee"))


def _top_employees(employees: DataFrame) -> DataFrame:
    """First 10 employees of a company by revenue, over all its sectors, with clean names."""
    first = top_per_group(employees, ["companyId"], ["-revenue", "employeeId"], COMPANY_EMPLOYEES)
    return first.select("companyId", "employeeId", "rank", "revenue", "salesCount", "avgSaleAmount",
                        names.clean_employee_name(F.col("employeeName"), F.col("employeeId")).alias("employeeName"))


def root_cause_employee(base: DataFrame, employees: DataFrame, per_employee: DataFrame) -> DataFrame:
    """Fewer than half of the first employees earn more than the market's average employee."""
    average = F.col("avgRevenuePerEmployee")
    pairs = (base.select("companyId", "sector").join(per_employee, "sector")
             .join(_top_employees(employees), "companyId").filter(average > 0))
    above = F.col("revenue") > average
    leader = F.when(above, F.struct((-F.col("revenue")).alias("o"), F.col("employeeId").cast("string").alias("i"),
                                    F.col("employeeName").alias("n")))
    trailer = F.when(~above, F.struct(F.col("revenue").alias("o"), F.col("employeeId").cast("string").alias("i"),
                                      F.col("employeeName").alias("n")))
    rows = pairs.groupBy("companyId", "sector").agg(
        F.count_if(above).alias("employeesAboveMarket"), F.count("*").alias("totalEmployees"),
        ratio(total("revenue"), F.count("*")).alias("companyAvgRevenuePerEmployee"),
        F.max(average).alias("marketAvgRevenuePerEmployee"),
        F.transform(F.slice(F.sort_array(F.collect_list(leader)), 1, 2), lambda e: e["n"]).alias("leaders"),
        F.transform(F.slice(F.sort_array(F.collect_list(trailer)), 1, 2), lambda e: e["n"]).alias("trailers"))
    share = percent(F.col("employeesAboveMarket"), F.col("totalEmployees"))
    rows = rows.withColumn("share", share).filter(F.col("share") < EMPLOYEE_PROBLEM)
    counts = (F.col("employeesAboveMarket"), F.col("totalEmployees"))
    market, own = F.col("marketAvgRevenuePerEmployee"), F.col("companyAvgRevenuePerEmployee")
    return rows.select(
        "companyId", "sector", F.lit("employee_performance").alias("type"),
        F.when(F.col("share") < EMPLOYEE_HIGH, "high").otherwise("medium").alias("severity"),
        say(texts.EMPLOYEE_WEAK, F.col("share"), *counts).alias("description"),
        F.concat(say(texts.EMPLOYEE_WEAK_ADVICE, *counts, F.col("share"), market, own, market),
                 F.when(F.size("leaders") > 0, say(texts.EMPLOYEE_LEADERS, listed(F.col("leaders"))))
                 .otherwise(texts.EMPLOYEE_NO_LEADERS)).alias("recommendation"),
        "employeesAboveMarket", "totalEmployees", F.col("share").alias("employeesAboveMarketPercentage"),
        "companyAvgRevenuePerEmployee", "marketAvgRevenuePerEmployee",
        F.concat_ws(",", "leaders").alias("topPerformers"), F.concat_ws(",", "trailers").alias("lowPerformers"))


def root_cause_category(base: DataFrame, company_categories: DataFrame, market_categories: DataFrame) -> DataFrame:
    """Another top category than the market's, or the same one with a much smaller share.

    Both tables have (…, sector, category, revenue).
    """
    own = _leaders(company_categories, ["companyId", "sector"], "category", "revenue", "own")
    market = _leaders(market_categories, ["sector"], "category", "revenue", "market")
    rows = (base.filter((F.col("revenue") > 0) & (F.col("marketRevenue") > 0))
            .join(own, ["companyId", "sector"]).join(market, "sector")
            .withColumn("ownShare", percent(F.col("ownTopRevenue"), F.col("revenue")))
            .withColumn("marketShare", percent(F.col("marketTopRevenue"), F.col("marketRevenue")))
            .withColumn("shareGap", F.col("ownShare") - F.col("marketShare"))
            .withColumn("sameCategory", F.col("ownTop") == F.col("marketTop"))
            .withColumn("missing", F.array_except("marketTop3", "ownTop3")))
    same, gap_size = F.col("sameCategory"), F.col("shareGap")
    differs = say(texts.CATEGORY_DIFFERS, F.col("ownTop"), F.col("marketTop"), F.col("marketTop"),
                  F.col("marketShare"), F.col("ownTop"), F.col("ownShare"))
    weak = say(texts.CATEGORY_WEAK, F.col("ownTop"), F.col("ownShare"), F.col("marketShare"), F.abs("shareGap"))
    advice = (F.when(~same & (F.size("missing") > 0),
                     say(texts.CATEGORY_DIFFERS_ADVICE, F.col("ownTop"), F.col("marketTop"),
                         listed(F.col("missing")), F.col("marketShare")))
              .when(same, say(texts.CATEGORY_WEAK_ADVICE, F.col("ownTop"), F.col("ownShare"),
                              F.col("marketShare"), F.col("ownTop")))
              .otherwise(texts.CATEGORY_ALIGNED))
    return rows.filter(~same | (gap_size < -CATEGORY_GAP)).select(
        "companyId", "sector", F.lit("product_category").alias("type"),
        F.when(same & (gap_size < -CATEGORY_HIGH), "high").otherwise("medium").alias("severity"),
        F.when(same, weak).otherwise(differs).alias("description"), advice.alias("recommendation"),
        F.col("ownTop").alias("companyTopCategory"), F.col("marketTop").alias("marketTopCategory"),
        F.col("ownTopRevenue").alias("companyCategoryRevenue"),
        F.col("marketTopRevenue").alias("marketCategoryRevenue"),
        F.col("ownShare").alias("companyCategoryPercentage"),
        F.col("marketShare").alias("marketCategoryPercentage"),
        F.concat_ws(",", "ownTop3").alias("top3CompanyCategories"),
        F.concat_ws(",", "marketTop3").alias("top3MarketCategories"),
        F.concat_ws(",", "missing").alias("missingCategories"), "sameCategory")


def employee_shares(base: DataFrame, employees: DataFrame) -> DataFrame:
    """First 5 employees of each company with their percent of the revenue in the sector."""
    first = _top_employees(employees).filter(F.col("rank") <= LISTED)
    whole = base.select("companyId", "sector", F.col("revenue").alias("whole"))
    return first.join(whole, "companyId").select(
        "companyId", "sector", "rank", "employeeId", "employeeName", "revenue", "salesCount", "avgSaleAmount",
        percent(F.col("revenue"), F.col("whole")).alias("percentage"))


def all_causes(*causes: DataFrame) -> DataFrame:
    """The shared columns of several rules, one row per cause."""
    rows = causes[0].select(*CAUSE)
    for other in causes[1:]:
        rows = rows.unionByName(other.select(*CAUSE))
    return rows


def root_cause_report(base: DataFrame, causes: DataFrame) -> DataFrame:
    """Number of causes, number of high ones and the recommendations of every examined company.

    A company has at most one cause per rule, so the collected list is short.
    """
    entry = F.struct("type", "recommendation")
    sums = causes.groupBy("companyId", "sector").agg(
        F.count("*").alias("totalRootCauses"), F.count_if(F.col("severity") == "high").alias("criticalIssues"),
        F.sort_array(F.collect_list(entry)).alias("entries"))
    found = sums.select("companyId", "sector", "totalRootCauses", "criticalIssues",
                        F.transform("entries", lambda e: e["type"]).alias("types"),
                        F.transform("entries", lambda e: e["recommendation"]).alias("recommendations"))
    return base.select("companyId", "sector").join(found, ["companyId", "sector"], "left").select(
        "companyId", "sector", F.coalesce("totalRootCauses", F.lit(0)).alias("totalRootCauses"),
        F.coalesce("criticalIssues", F.lit(0)).alias("criticalIssues"),
        F.coalesce(F.concat_ws(",", "types"), F.lit("")).alias("types"),
        F.coalesce("recommendations", F.array().cast("array<string>")).alias("recommendations"))
