"""What a micro-batch of sales or items changes in the ten result tables.

Each stream is read once. Its batch is reduced to cells first, one row for each combination of the tables' keys with
additive measures, and every table's changes are rolled up from the cells; no stream keeps state for a measure. Market
tables take the changes of their company tables: sums add up, a company counts when its row is new. Items meet their
sales within the batch (``pairs``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.measures import EXACT, exact_total, ratio, total_again
from salesloom.operators.filters import completed, has_employee, known, with_brand, with_sector
from salesloom.operators.joins import enrich_items, name_employees, name_products
from salesloom.plans import tables
from salesloom.streaming.kept import PARTS, Kept, merge, read

COMPANY = Kept("company_analytics", ["companyId", "sector"], ["revenue"], ["salesCount"])
MARKET = Kept("market_analytics", ["sector"], ["marketRevenue"], ["marketSalesCount", "totalCompanies"])
REGION = Kept("sales_by_region", ["region", "sector"], ["revenue"], ["salesCount"])
EMPLOYEES = Kept("company_employees", ["companyId", "employeeId"], ["revenue"], ["salesCount"], texts=["sector"])
MARKET_EMPLOYEES = Kept("market_employee_performance", ["sector"], ["revenue"], ["totalSales"], sketches=["employees"])
PRODUCTS = Kept("company_top_products", ["companyId", "sector", "productId"], ["totalRevenue"], ["totalQuantity"],
                texts=["brand"])
MARKET_PRODUCTS = Kept("market_top_products", ["sector", "productId"], ["totalRevenue"], ["totalQuantity"],
                       texts=["brand"])
BRANDS = Kept("company_brands", ["companyId", "sector", "brand"], ["revenue", "listWorth"], ["quantity", "pricedQuantity"])
MARKET_BRANDS = Kept("market_top_brands", ["sector", "brand"], ["totalRevenue"], peaks=["maxQuantity"],
                     sketches=["products"])
OF_SALES = [COMPANY, MARKET, REGION, EMPLOYEES, MARKET_EMPLOYEES]
OF_ITEMS = [PRODUCTS, MARKET_PRODUCTS, BRANDS, MARKET_BRANDS]


def sales_cells(sales: DataFrame) -> DataFrame:
    return completed(sales).groupBy("companyId", "sector", "region", "employeeId").agg(
        exact_total("totalAmount").alias("revenue"), F.count("*").alias("salesCount"))


def _added(cells: DataFrame, keys: list[str], *more) -> DataFrame:
    return cells.groupBy(*keys).agg(
        total_again("revenue").alias("revenue"), F.sum("salesCount").alias("salesCount"), *more)


def keep_sales(batch: DataFrame, batch_id: int, root: str, parts: int = PARTS) -> None:
    """Merge a batch of sales into the five tables that follow from sales alone."""
    cells = sales_cells(batch).persist()
    try:
        company = _added(known(cells, "companyId", "sector"), ["companyId", "sector"])
        now = merge(company, batch_id, root, COMPANY, parts)
        fresh = now.filter(F.col("first_batch") == batch_id).groupBy("sector").agg(F.count("*").alias("totalCompanies"))
        sector = company.groupBy("sector").agg(total_again("revenue").alias("marketRevenue"),
                                               F.sum("salesCount").alias("marketSalesCount"))
        merge(sector.join(fresh, "sector", "left").withColumn(
            "totalCompanies", F.coalesce("totalCompanies", F.lit(0).cast("bigint"))), batch_id, root, MARKET, parts)
        merge(_added(known(cells, "region", "sector"), ["region", "sector"]), batch_id, root, REGION, parts)
        people = known(has_employee(cells), "companyId")
        merge(_added(people, ["companyId", "employeeId"], F.min("sector").alias("sector")), batch_id, root, EMPLOYEES, parts)
        merge(known(people, "sector").groupBy("sector").agg(
            total_again("revenue").alias("revenue"), F.sum("salesCount").alias("totalSales"),
            F.hll_sketch_agg("employeeId").alias("employees")), batch_id, root, MARKET_EMPLOYEES, parts)
    finally:
        cells.unpersist()


def item_cells(lines: DataFrame) -> DataFrame:
    """Lines by company and product; ``headCompany`` is the company of the completed sale they belong to, if any."""
    return lines.groupBy("companyId", "sector", "productId", "brand", "headCompany").agg(
        exact_total("subtotal").alias("totalRevenue"), F.sum(F.col("quantity").cast("bigint")).alias("totalQuantity"))


def keep_items(batch: DataFrame, batch_id: int, root: str, products: DataFrame | None, parts: int = PARTS) -> None:
    """Merge a batch of items, joined with their sales, into the four tables of products and brands.

    Product tables take items of sales of any status, brand tables those of completed sales under the sale's company.
    Dimensions are joined to the cells. A company's quantity of a brand only grows, so the market's largest is that of
    the rows that changed or the one before.
    """
    def sums() -> list:
        return [total_again("totalRevenue").alias("totalRevenue"), F.sum("totalQuantity").alias("totalQuantity")]

    cells = item_cells(batch).persist()
    try:
        sold = known(cells, "productId", "companyId", "sector")
        company = sold.groupBy(*PRODUCTS.keys).agg(*sums(), F.min("brand").alias("brand"))
        merge(company, batch_id, root, PRODUCTS, parts)
        merge(company.groupBy(*MARKET_PRODUCTS.keys).agg(*sums(), F.min("brand").alias("brand")), batch_id, root,
              MARKET_PRODUCTS, parts)
        branded = with_brand(with_sector(cells)).filter(F.col("headCompany").isNotNull())
        branded = with_brand(enrich_items(branded, products)).withColumn("companyId", F.col("headCompany"))
        worth = (F.col("productPrice").cast("decimal(18,4)") * F.col("totalQuantity")).cast(EXACT)
        priced = F.when(F.col("productPrice").isNotNull(), F.col("totalQuantity"))
        own = branded.groupBy(*BRANDS.keys).agg(
            total_again("totalRevenue").alias("revenue"), F.sum("totalQuantity").alias("quantity"),
            F.coalesce(total_again(worth), F.lit(0).cast(EXACT)).alias("listWorth"),
            F.coalesce(F.sum(priced), F.lit(0).cast("bigint")).alias("pricedQuantity"))
        now = merge(own, batch_id, root, BRANDS, parts)
        most = now.groupBy("sector", "brand").agg(F.max("quantity").alias("maxQuantity"))
        market = branded.groupBy("sector", "brand").agg(
            total_again("totalRevenue").alias("totalRevenue"), F.hll_sketch_agg("productId").alias("products"))
        merge(market.join(most, ["sector", "brand"]), batch_id, root, MARKET_BRANDS, parts)
    finally:
        cells.unpersist()


# ---------------------------------------------------------------- reading

def result_tables(spark: SparkSession, root: str, products: DataFrame | None = None,
                  employees: DataFrame | None = None) -> Mapping[str, Callable[[], DataFrame]]:
    """The ten result tables as they are stored; names are looked up when a table is read."""
    def stored(table: Kept) -> DataFrame:
        rows = read(spark, root, table)
        return rows.withColumns({c: F.col(c).cast("double") for c in table.money})

    def company() -> DataFrame:
        return stored(COMPANY).select("companyId", "sector", "revenue", "salesCount",
                                      ratio(F.col("revenue"), F.col("salesCount")).alias("avgSaleAmount"))

    def market() -> DataFrame:
        return stored(MARKET).select(
            "sector", "marketRevenue", "marketSalesCount",
            ratio(F.col("marketRevenue"), F.col("marketSalesCount")).alias("marketAvgSale"), "totalCompanies")

    def named_products(table: Kept) -> DataFrame:
        rows = stored(table).withColumn("avgPrice", ratio(F.col("totalRevenue"), F.col("totalQuantity")))
        return name_products(rows, products).select(
            *table.keys, "productName", "brand", "totalRevenue", "totalQuantity", "avgPrice")

    def brands() -> DataFrame:
        return tables.company_brands(stored(BRANDS).select(
            *BRANDS.keys, "revenue", "quantity", F.try_divide("listWorth", "pricedQuantity").alias("avgPrice")))

    def market_brands() -> DataFrame:
        return stored(MARKET_BRANDS).select("sector", "brand", "totalRevenue", "maxQuantity",
                                            F.hll_sketch_estimate("products").alias("productCount"))

    def people() -> DataFrame:
        rows = stored(EMPLOYEES).withColumn("avgSaleAmount", ratio(F.col("revenue"), F.col("salesCount")))
        return name_employees(rows, employees).select(
            "companyId", "employeeId", "sector", "employeeName", "revenue", "salesCount", "avgSaleAmount")

    def market_people() -> DataFrame:
        return stored(MARKET_EMPLOYEES).select(
            "sector", ratio(F.col("revenue"), F.col("totalSales")).alias("avgSaleAmount"), "totalSales",
            F.hll_sketch_estimate("employees").alias("totalEmployees"))

    return {
        "company_analytics": company, "market_analytics": market,
        "sales_by_sector": lambda: tables.sales_by_sector(market()),
        "sales_by_region": lambda: stored(REGION).select("region", "sector", "revenue", "salesCount"),
        "company_top_products": lambda: named_products(PRODUCTS),
        "market_top_products": lambda: named_products(MARKET_PRODUCTS),
        "company_brands": brands, "market_top_brands": market_brands,
        "company_employees": people, "market_employee_performance": market_people,
    }
