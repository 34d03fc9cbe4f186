"""Items of sales reduced once to cells, from which every table of products, brands and categories is rolled up.

A cell is one combination of company, sector, product, the item's own brand and category with additive measures.
Dimensions are joined to cells, so a product is looked up once for each company that sells it and not for each line.
Roll-ups of the same cells share one shuffle of them: Spark sees that it is the same and reads it again, as long as
conditions stand behind the cells. So what takes part is decided by measures here and not by filters on the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.measures import ratio, total, total_again
from salesloom.operators.filters import known
from salesloom.operators.joins import enrich_items, items_with_sale, name_products

KEYS = ["productId", "brand", "categoryId"]


def item_cells(items: DataFrame, sales: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """revenue and quantity of items of sales of any status, soldRevenue and soldQuantity of completed ones.

    The latter are null where no sale was completed.
    """
    done = F.col("saleStatus") == "completed"
    placed = items_with_sale(items, sales, ["companyId", "sector", "saleStatus"])
    return placed.groupBy("companyId", "sector", *by).agg(
        total("subtotal").alias("revenue"), F.sum("quantity").alias("quantity"),
        total(F.when(done, F.col("subtotal"))).alias("soldRevenue"),
        F.sum(F.when(done, F.col("quantity"))).alias("soldQuantity"))


def _sum(c: Column) -> Column:
    return total_again(c).cast("double")


def _named(sums: DataFrame, products: DataFrame | None) -> DataFrame:
    return name_products(sums.withColumn("avgPrice", ratio(F.col("totalRevenue"), F.col("totalQuantity"))), products)


def _product_sums() -> list[Column]:
    return [_sum(F.col("revenue")).alias("totalRevenue"), F.sum("quantity").alias("totalQuantity")]


def company_products(cells: DataFrame, products: DataFrame | None) -> DataFrame:
    """Products of each company, from cells by product."""
    rows = known(cells, "productId", "companyId", "sector").select(
        "companyId", "sector", "productId", F.col("revenue").alias("totalRevenue"), F.col("quantity").alias("totalQuantity"))
    return _named(rows, products)


def market_products(cells: DataFrame, products: DataFrame | None) -> DataFrame:
    return _named(known(cells, "productId", "companyId", "sector").groupBy("sector", "productId").agg(*_product_sums()),
                  products)


def company_categories(cells: DataFrame) -> DataFrame:
    """Revenue of each category in completed sales."""
    sums = cells.groupBy("companyId", "sector", F.col("categoryId").alias("category")).agg(
        _sum(F.col("soldRevenue")).alias("revenue"))
    return sums.filter(F.col("revenue").isNotNull())


def market_categories(categories: DataFrame) -> DataFrame:
    return categories.groupBy("sector", "category").agg(_sum(F.col("revenue")).alias("revenue"))


def _branded(cells: DataFrame, products: DataFrame | None) -> DataFrame:
    """Cells with the product's brand and price. ``counts`` marks those of completed sales that have a sector, a brand
    of their own and one in the end."""
    own = F.coalesce((F.col("brand") != "") & F.col("sector").isNotNull() & F.col("companyId").isNotNull(), F.lit(False))
    cells = enrich_items(cells.withColumn("own", own), products)
    return cells.withColumn("counts", F.col("own") & F.col("soldRevenue").isNotNull() & F.coalesce(
        F.col("brand") != "", F.lit(False)))


def _brand_measures() -> list[Column]:
    counts, sold = F.col("counts"), F.col("soldQuantity")
    priced = counts & F.col("productPrice").isNotNull()
    worth = F.when(priced, F.col("productPrice").cast("decimal(18,4)") * sold)
    return [_sum(F.when(counts, F.col("soldRevenue"))).alias("revenue"), F.sum(F.when(counts, sold)).alias("quantity"),
            F.try_divide(_sum(worth), F.sum(F.when(priced, sold))).alias("avgPrice"),
            F.count_if(counts).alias("n")]


def company_brands(cells: DataFrame, products: DataFrame | None) -> DataFrame:
    """Every brand of every company; avgPrice is the list price weighted by quantity."""
    rows = _branded(cells, products).groupBy("companyId", "sector", "brand").agg(*_brand_measures())
    return rows.filter("n > 0").drop("n")


def market_brands(cells: DataFrame, products: DataFrame | None) -> DataFrame:
    """totalRevenue, the largest quantity of a company and the number of distinct products of each brand.

    Sums by company and counts by product come from one pass over the cells.
    """
    rows = _branded(cells, products).groupingSets(
        [["sector", "brand", "companyId"], ["sector", "brand", "productId"]],
        "sector", "brand", "companyId", "productId").agg(
        _sum(F.when(F.col("counts"), F.col("soldRevenue"))).alias("revenue"),
        F.sum(F.when(F.col("counts"), F.col("soldQuantity"))).alias("quantity"),
        F.count_if("counts").alias("n"), F.grouping("companyId").alias("ofProduct"))
    own = F.col("ofProduct") == 0
    return rows.filter("n > 0").groupBy("sector", "brand").agg(
        _sum(F.when(own, F.col("revenue"))).alias("totalRevenue"), F.max(F.when(own, F.col("quantity"))).alias("maxQuantity"),
        F.count(F.when(~own, F.col("productId"))).alias("productCount"))
