"""Dashboards: key figures, breakdowns, trends and rankings of sales and items.

Raw-fact questions take every status unless filtered; table questions read the result tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import buckets, names
from salesloom.functions.measures import or_zero, ratio, sales_measures, total
from salesloom.operators.filters import ALL, Filters, apply_filters, day_range, equal_to, has_employee
from salesloom.operators.joins import (items_of_matching_sales, items_with_category, items_with_product,
                                       items_with_sale, lookup)
from salesloom.operators.topk import top, top_per_group

SALE_COLUMNS = ["saleTime", "companyId", "branchId", "region", "sector", "saleStatus"]


# Key figures.
def sales_summary(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    revenue, count, average = sales_measures()
    sums = apply_filters(sales, f).agg(revenue, count, average)
    return sums.select(or_zero("totalRevenue").alias("totalRevenue"), "totalSales",
                       or_zero("avgSaleAmount").alias("averageSaleAmount"))


def _count_and_revenue(sales: DataFrame, key: str) -> DataFrame:
    return sales.groupBy(key).agg(F.count("*").alias("count"), total("totalAmount").alias("revenue"))


def sales_by_status(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    return _count_and_revenue(apply_filters(sales, f), "saleStatus")


def sales_by_type(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    return _count_and_revenue(apply_filters(sales, f), "saleType")


def summary_from_tables(company: DataFrame, market: DataFrame, f: Filters,
                        sales: DataFrame | None = None) -> DataFrame:
    """Key figures from the small tables: a company over its sectors, else a sector, else the facts.

    The tables hold all time and all places, so any other filter is answered from the facts. Which source answers
    depends on the filters alone; a company or sector without sales has zeros either way.
    """
    only = Filters(companyId=f.companyId, sector=f.sector)
    if f != only and sales is not None:
        return sales_summary(sales, f)
    if f != only:
        raise ValueError("with other filters than company and sector the sales are needed")
    if f.companyId is not None:
        rows = equal_to(company, companyId=f.companyId, sector=f.sector).select(
            F.col("revenue"), F.col("salesCount"))
    elif f.sector is not None:
        rows = equal_to(market, sector=f.sector).select(
            F.col("marketRevenue").alias("revenue"), F.col("marketSalesCount").alias("salesCount"))
    else:
        rows = None
    if rows is None and sales is None:
        raise ValueError("without company and sector the sales are needed")
    if rows is None:
        return sales_summary(sales, f)
    sums = rows.agg(or_zero(total("revenue")).alias("totalRevenue"),
                    or_zero(F.sum("salesCount")).alias("totalSales"))
    return sums.withColumn("averageSaleAmount", ratio(F.col("totalRevenue"), F.col("totalSales")))


# Breakdowns of sales.
def sales_by_region(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    return top(apply_filters(sales, f).groupBy("region").agg(*sales_measures()), ["-totalRevenue", "region"])


def sales_by_company(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    sums = apply_filters(sales, f).groupBy("companyId").agg(
        *sales_measures(), F.count_distinct("branchId").alias("branchCount"))
    return top(sums, ["-totalRevenue", "companyId"])


def sector_companies(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    return top(apply_filters(sales, f).groupBy("sector", "companyId").agg(*sales_measures()),
               ["-totalRevenue", "sector", "companyId"])


def sector_regions(sales: DataFrame, f: Filters = ALL) -> DataFrame:
    return top(apply_filters(sales, f).groupBy("sector", "region").agg(*sales_measures()),
               ["-totalRevenue", "sector", "region"])


def company_in_sector(sales: DataFrame, company_id: str, sector: str, f: Filters = ALL) -> DataFrame:
    revenue, count, average = sales_measures()
    sums = equal_to(apply_filters(sales, f), companyId=company_id, sector=sector).agg(revenue, count, average)
    return sums.select(or_zero("totalRevenue").alias("totalRevenue"), "totalSales",
                       or_zero("avgSaleAmount").alias("avgSaleAmount"))


def sector_companies_table(company: DataFrame, sector: str | None = None) -> DataFrame:
    rows = equal_to(company, sector=sector).select(
        "companyId", "sector", F.col("revenue").alias("totalRevenue"), F.col("salesCount").alias("totalSales"),
        "avgSaleAmount")
    return top(rows, ["-totalRevenue", "companyId", "sector"])


def regions_table(region: DataFrame, sector: str | None = None) -> DataFrame:
    rows = equal_to(region, sector=sector).select(
        "region", "sector", F.col("revenue").alias("totalRevenue"), F.col("salesCount").alias("totalSales"),
        ratio(F.col("revenue"), F.col("salesCount")).alias("avgSaleAmount"))
    return top(rows, ["-totalRevenue", "region", "sector"])


def sales_trends(sales: DataFrame, period: str = "day", f: Filters = ALL) -> DataFrame:
    rows = apply_filters(sales, f).withColumn("bucket", buckets.label("saleTime", period))
    return top(rows.groupBy("bucket").agg(*sales_measures()), ["bucket"])


# Breakdowns of items.
def _sold(items: DataFrame, sales: DataFrame, f: Filters) -> DataFrame:
    """Items of the selected sales; only the columns the filters name are read from the sales."""
    return items_of_matching_sales(day_range(items, f.start, f.end), apply_filters(sales, f))


def top_products(items: DataFrame, sales: DataFrame, products: DataFrame, f: Filters = ALL,
                 k: int | None = 10) -> DataFrame:
    """Products by quantity; items are grouped before the product is looked up."""
    sums = _sold(items, sales, f).groupBy("productId").agg(
        F.sum("quantity").alias("totalQuantity"), total("subtotal").alias("totalRevenue"),
        F.count("*").alias("totalSales"), F.avg("price").alias("avgPrice"))
    named = items_with_product(sums, products, ["productName", "brand"])
    return top(named, ["-totalQuantity", "productId"], k)


def company_top_products_batch(items: DataFrame, sales: DataFrame, products: DataFrame, company_id: str,
                               f: Filters = ALL, k: int = 15) -> DataFrame:
    """Products of one company by revenue; products missing from the dimension stay."""
    own = equal_to(apply_filters(sales, f), companyId=company_id)
    sums = items_of_matching_sales(items, own).groupBy("productId").agg(
        total("subtotal").alias("totalRevenue"), F.sum("quantity").alias("totalQuantity"),
        F.count("*").alias("totalSales"))
    named = items_with_product(sums, products, ["productName", "brand"], "left")
    return top(named, ["-totalRevenue", "productId"], k)


def products_by_brand(items: DataFrame, sales: DataFrame, f: Filters = ALL) -> DataFrame:
    sums = _sold(items, sales, f).groupBy("brand").agg(
        F.sum("quantity").alias("totalQuantity"), total("subtotal").alias("totalRevenue"),
        F.count("*").alias("totalSales"), F.avg("price").alias("avgPrice"))
    return top(sums, ["-totalRevenue", "brand"])


def products_by_category(items: DataFrame, sales: DataFrame, categories: DataFrame,
                         f: Filters = ALL) -> DataFrame:
    """Categories without a name, and items without a category, stay."""
    sums = _sold(items, sales, f).groupBy("categoryId").agg(
        F.sum("quantity").alias("totalQuantity"), total("subtotal").alias("totalRevenue"),
        F.count("*").alias("totalSales"))
    return top(items_with_category(sums, categories), ["-totalRevenue", "categoryId"])


def top_products_table(table: DataFrame, k: int = 10, **values: str) -> DataFrame:
    """First k products by revenue of each company, or of each sector of the market (10, 15 or 50)."""
    rows = equal_to(table, **values).withColumn("productName", F.coalesce("productName", F.lit(names.UNKNOWN_NAME)))
    group = "companyId" if "companyId" in table.columns else "sector"
    tie = [c for c in ("sector", "productId") if c in table.columns]
    return top_per_group(rows, [group], ["-totalRevenue", *tie], k).drop("rank")


def brands_table(table: DataFrame, **values: str) -> DataFrame:
    """Company or market brand table by revenue."""
    revenue = "revenue" if "revenue" in table.columns else "totalRevenue"
    tie = [c for c in ("companyId", "sector", "brand") if c in table.columns]
    return top(equal_to(table, **values), ["-" + revenue, *tie])


# Employees.
def _employee_sums(sales: DataFrame) -> DataFrame:
    return has_employee(sales).groupBy("employeeId").agg(*sales_measures(), F.max("totalAmount").cast("double").alias("maxSaleAmount"))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("employeeName", F.coalesce("employeeName", F.lit(names.UNKNOWN_NAME))) \
             .withColumn("position", F.coalesce("position", F.lit(names.UNKNOWN_POSITION)))


def employee_performance(sales: DataFrame, employees: DataFrame, f: Filters = ALL, k: int | None = 10) -> DataFrame:
    """Employees by revenue; with a company only employees of that company remain."""
    sums = _employee_sums(apply_filters(sales, f))
    if f.companyId is None:
        rows = lookup(sums, employees, "employeeId", ["employeeName", "position"])
    else:
        rows = lookup(sums, equal_to(employees, companyId=f.companyId), "employeeId",
                      ["employeeName", "position"], "inner")
    return top(_named(rows), ["-totalRevenue", "employeeId"], k)


def company_employee_performance(sales: DataFrame, employees: DataFrame, f: Filters = ALL,
                                 k: int | None = 50) -> DataFrame:
    """First k employees of each company that made the sales, for all companies or the filtered one."""
    sums = has_employee(apply_filters(sales, f)).groupBy("companyId", "employeeId").agg(*sales_measures())
    rows = lookup(sums, employees, ["employeeId", "companyId"], ["employeeName", "position"], "inner")
    order = ["-totalRevenue", "employeeId"]
    return top(rows, ["companyId", *order]) if k is None else top_per_group(rows, ["companyId"], order, k).drop("rank")


def employees_table(table: DataFrame, company_id: str | None = None, k: int = 10) -> DataFrame:
    rows = equal_to(table, companyId=company_id).select(
        "companyId", "employeeId", F.coalesce("employeeName", F.lit(names.UNKNOWN_NAME)).alias("employeeName"),
        F.lit(names.UNKNOWN_POSITION).alias("position"), F.col("revenue").alias("totalRevenue"),
        F.col("salesCount").alias("totalSales"), "avgSaleAmount",
        F.col("avgSaleAmount").alias("maxSaleAmount"))
    return top(rows, ["-totalRevenue", "companyId", "employeeId"], k)


# Whole dashboards.
def dashboard(sales: DataFrame, items: DataFrame, products: DataFrame, employees: DataFrame,
              f: Filters = ALL) -> dict[str, DataFrame]:
    """The parts of the main dashboard; each part is its own small result.

    All parts about sales are roll-ups of one grouping, so the sales are read once for them.
    """
    cells = apply_filters(sales, f).groupBy("region", "companyId", "employeeId").agg(
        total("totalAmount").alias("totalRevenue"), F.count("*").alias("totalSales"),
        F.max("totalAmount").cast("double").alias("maxSaleAmount"))

    def rolled(*keys: str) -> DataFrame:
        sums = cells.groupBy(*keys).agg(
            or_zero(total("totalRevenue")).alias("totalRevenue"), or_zero(F.sum("totalSales")).alias("totalSales"),
            F.max("maxSaleAmount").alias("maxSaleAmount"))
        return sums.withColumn("avgSaleAmount", ratio(F.col("totalRevenue"), F.col("totalSales")))

    people = has_employee(rolled("employeeId"))
    own = employees if f.companyId is None else equal_to(employees, companyId=f.companyId)
    named = lookup(people, own, "employeeId", ["employeeName", "position"], "left" if f.companyId is None else "inner")
    return {
        "summary": rolled().drop("maxSaleAmount"),
        "salesByRegion": top(rolled("region").drop("maxSaleAmount"), ["-totalRevenue", "region"], 10),
        "salesByCompany": top(rolled("companyId").drop("maxSaleAmount"), ["-totalRevenue", "companyId"], 10),
        "topProducts": top_products(items, sales, products, f, 10),
        "employeePerformance": top(_named(named), ["-totalRevenue", "employeeId"], 10),
    }


def long_form(parts: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Dashboard parts as one table: section, key, totalRevenue, totalSales, totalQuantity."""
    measures = ["totalRevenue", "totalSales", "totalQuantity"]
    rows = None
    for section, (df, key) in parts.items():
        part = df.select(
            F.lit(section).alias("section"),
            (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
            *[(F.col(m) if m in df.columns else F.lit(None)).cast("double").alias(m)
              for m in measures])
        rows = part if rows is None else rows.unionByName(part)
    return rows


DASHBOARD_KEYS = {"summary": None, "salesByRegion": "region", "salesByCompany": "companyId",
                  "topProducts": "productId", "employeePerformance": "employeeId"}


def dashboard_table(sales: DataFrame, items: DataFrame, products: DataFrame, employees: DataFrame,
                    f: Filters = ALL) -> DataFrame:
    parts = dashboard(sales, items, products, employees, f)
    return long_form({name: (df, DASHBOARD_KEYS[name]) for name, df in parts.items()})


def company_overview(company: DataFrame, market: DataFrame, region: DataFrame, company_id: str,
                     sector: str | None = None) -> DataFrame:
    """Key figures of a company and the regions of its sector (of all sectors when none is given)."""
    summary = summary_from_tables(company, market, Filters(companyId=company_id, sector=sector))
    return long_form({"summary": (summary, None), "sectorRegions": (regions_table(region, sector), "region")})


def sector_overview(market: DataFrame, region: DataFrame, market_products: DataFrame, sector: str,
                    k: int = 50) -> DataFrame:
    summary = equal_to(market, sector=sector).select(
        F.col("marketRevenue").alias("totalRevenue"), F.col("marketSalesCount").alias("totalSales"))
    companies = equal_to(market, sector=sector).select(F.col("totalCompanies").alias("totalSales"))
    return long_form({
        "summary": (summary, None), "totalCompanies": (companies, None),
        "salesByRegion": (regions_table(region, sector), "region"),
        "topProducts": (top_products_table(market_products, k, sector=sector), "productId")})


def combined_market(market: DataFrame, region: DataFrame, market_products: DataFrame,
                    sectors: Sequence[str], k: int = 20) -> DataFrame:
    """Several sectors seen as one market: products and regions are added up, then the first k are shown."""
    rows = market_products.filter(F.col("sector").isin(*sectors))
    products = top(rows.groupBy("productId").agg(F.sum("totalQuantity").alias("totalQuantity"),
                                                 total("totalRevenue").alias("totalRevenue")),
                   ["-totalQuantity", "productId"], k)
    chosen = F.col("sector").isin(*sectors)
    regions = region.filter(chosen).groupBy("region").agg(
        total("revenue").alias("totalRevenue"), F.sum("salesCount").alias("totalSales"))
    summary = market.filter(chosen).agg(total("marketRevenue").alias("totalRevenue"),
                                        F.sum("totalCompanies").alias("totalSales"))
    return long_form({"topProducts": (products, "productId"),
                      "salesByRegion": (top(regions, ["-totalSales", "region"]), "region"),
                      "summary": (summary, None)})


def region_share(region: DataFrame) -> DataFrame:
    """Share of each region in the number of sales, in percent with one decimal.

    The total is a scalar subquery over the grouped regions, not an unpartitioned window.
    """
    sums = region.groupBy("region").agg(F.sum("salesCount").alias("totalSales"),
                                        total("revenue").alias("totalRevenue"))
    whole = sums.agg(F.sum("totalSales")).scalar()
    shown = sums.filter(F.col("region").isNotNull() & (F.col("region") != "") & (F.col("totalSales") > 0))
    return shown.select("region", "totalSales", F.round("totalRevenue", 0).alias("revenue"),
                        F.round(F.col("totalSales") / whole * 100, 1).alias("percentage"))
