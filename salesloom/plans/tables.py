"""The ten result tables, computed from facts in one pass each.

Facts are grouped first and dimensions are joined to the groups, so a hot product or company is one
row by the time anything is looked up. Market tables are roll-ups of company tables and never read
the facts again. The streaming ledger produces the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.measures import mean, ratio, total
from salesloom.operators.filters import completed, has_employee, known, with_brand, with_sector
from salesloom.operators.grouping import group_with_texts
from salesloom.operators.joins import enrich_items, items_with_sale, name_employees, name_products
from salesloom.operators.topk import top_per_group

TOP_BRANDS = 5  # fixed value: brands shown per company and sector


# Tables of sales.
def company_analytics(sales: DataFrame) -> DataFrame:
    done = known(completed(sales), "companyId", "sector")
    return done.groupBy("companyId", "sector").agg(
        total("totalAmount").alias("revenue"), F.count("*").alias("salesCount"),
        mean("totalAmount").alias("avgSaleAmount"))


def market_analytics(company: DataFrame) -> DataFrame:
    """One row per company and sector comes in, so the companies are counted, not collected."""
    sums = company.groupBy("sector").agg(
        total("revenue").alias("marketRevenue"), F.sum("salesCount").alias("marketSalesCount"),
        F.count("companyId").alias("totalCompanies"))
    return sums.select("sector", "marketRevenue", "marketSalesCount",
                       ratio(F.col("marketRevenue"), F.col("marketSalesCount")).alias("marketAvgSale"),
                       "totalCompanies")


def sales_by_sector(market: DataFrame) -> DataFrame:
    return market.select("sector", F.col("marketRevenue").alias("revenue"),
                         F.col("marketSalesCount").alias("salesCount"),
                         F.col("marketAvgSale").alias("avgSaleAmount"))


def sales_by_region(sales: DataFrame) -> DataFrame:
    done = known(completed(sales), "region", "sector")
    return done.groupBy("region", "sector").agg(
        total("totalAmount").alias("revenue"), F.count("*").alias("salesCount"))


# Tables of products. Items carry companyId and sector, as the item messages do.
def company_top_products(items: DataFrame, products: DataFrame | None) -> DataFrame:
    """Items of sales of any status."""
    sold = group_with_texts(
        known(items, "productId", "companyId", "sector"), ["companyId", "sector", "productId"], ["brand"],
        {"totalRevenue": total("subtotal"), "totalQuantity": F.sum("quantity")})
    sold = sold.withColumn("avgPrice", ratio(F.col("totalRevenue"), F.col("totalQuantity")))
    return name_products(sold, products).select(
        "companyId", "sector", "productId", "productName", "brand", "totalRevenue", "totalQuantity", "avgPrice")


def market_top_products(company: DataFrame) -> DataFrame:
    sums = group_with_texts(company, ["sector", "productId"], ["productName", "brand"], {
        "totalRevenue": total("totalRevenue"), "totalQuantity": F.sum("totalQuantity")})
    return sums.withColumn("avgPrice", ratio(F.col("totalRevenue"), F.col("totalQuantity")))


# Tables of brands.
def branded_items(items: DataFrame, sales: DataFrame, products: DataFrame | None) -> DataFrame:
    """Items of completed sales under the company of the sale, with the product's brand.

    As in the stream, an item needs a sector and a brand of its own to take part.
    """
    own = with_brand(with_sector(items))
    joined = items_with_sale(own, completed(sales), ["companyId"])
    return known(with_brand(enrich_items(joined, products)), "companyId")


def company_brands_all(branded: DataFrame) -> DataFrame:
    """Every brand of every company; avgPrice is the list price weighted by quantity."""
    priced = F.col("productPrice").isNotNull()
    worth = total(F.col("productPrice") * F.col("quantity"))
    return branded.groupBy("companyId", "sector", "brand").agg(
        total("subtotal").alias("revenue"), F.sum("quantity").alias("quantity"),
        F.try_divide(worth, F.sum(F.when(priced, F.col("quantity")))).alias("avgPrice"))


def company_brands(brands: DataFrame) -> DataFrame:
    """The first brands of each company by revenue, cut after everything has been added up."""
    return top_per_group(brands, ["companyId", "sector"], ["-revenue", "brand"], TOP_BRANDS, "rank")


def market_top_brands(brands: DataFrame, branded: DataFrame | None = None) -> DataFrame:
    """Roll-up of all company brands; productCount needs the items, maxQuantity does not."""
    sums = brands.groupBy("sector", "brand").agg(
        total("revenue").alias("totalRevenue"), F.max("quantity").alias("maxQuantity"))
    if branded is None:
        return sums
    counts = branded.groupBy("sector", "brand").agg(F.count_distinct("productId").alias("productCount"))
    return sums.join(counts, ["sector", "brand"], "left")


# Tables of employees.
def company_employees(sales: DataFrame, employees: DataFrame | None) -> DataFrame:
    done = known(has_employee(completed(sales)), "companyId")
    sums = group_with_texts(done, ["companyId", "employeeId"], ["sector"], {
        "revenue": total("totalAmount"), "salesCount": F.count("*")})
    sums = sums.withColumn("avgSaleAmount", ratio(F.col("revenue"), F.col("salesCount")))
    return name_employees(sums, employees).select(
        "companyId", "employeeId", "sector", "employeeName", "revenue", "salesCount", "avgSaleAmount")


def market_employee_performance(employees: DataFrame) -> DataFrame:
    """Distinct employees: the two-step count shuffles (sector, employee) pairs, never a whole sector."""
    sums = known(employees, "sector").groupBy("sector").agg(
        F.sum("salesCount").alias("totalSales"), total("revenue").alias("revenue"),
        F.count_distinct("employeeId").alias("totalEmployees"))
    return sums.select("sector", ratio(F.col("revenue"), F.col("totalSales")).alias("avgSaleAmount"),
                       "totalSales", "totalEmployees")
