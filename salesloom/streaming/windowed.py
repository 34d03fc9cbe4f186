"""The ten windowed aggregations. Each function takes a stream or a static DataFrame alike.

Sums and counts are carried next to every average, so windows can be added up later. Names and brands
of a product or an employee are looked up after the aggregation, once per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.measures import mean, total
from salesloom.operators.filters import completed, has_employee, known, with_brand, with_sector
from salesloom.operators.grouping import group_with_texts
from salesloom.operators.joins import enrich_items, enrich_sales, name_products

# Default windows and delays.
HALF_MINUTE, MINUTE, TWO_MINUTES = "30 seconds", "1 minute", "2 minutes"


def _timed(df: DataFrame, watermark: str, time: str = "saleTime") -> DataFrame:
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)


def _flat(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "w"]
    return df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def _windows(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], window: str,
             watermark: str) -> DataFrame:
    slot = F.window("saleTime", window).alias("w")
    return _flat(_timed(df, watermark).groupBy(slot, *keys).agg(*aggregates))


def _sale_sums() -> list[Column]:
    return [total("totalAmount").alias("revenue"), F.count("*").alias("salesCount"),
            mean("totalAmount").alias("avgSaleAmount")]


def _product_windows(items: DataFrame, keys: Sequence[str], window: str, watermark: str) -> DataFrame:
    timed = _timed(items, watermark).withColumn("w", F.window("saleTime", window))
    sums = group_with_texts(timed, ["w", *keys], ["brand"], {
        "totalRevenue": total("subtotal"), "totalQuantity": F.sum("quantity"),
        "priceSum": F.sum("price"), "lines": F.count("price")}, plain=["priceSum"])
    return _flat(sums.withColumn("avgPrice", F.try_divide("priceSum", "lines")).drop("priceSum", "lines"))


def sector_windows(sales: DataFrame, window: str = HALF_MINUTE, watermark: str = MINUTE) -> DataFrame:
    return _windows(completed(sales), ["sector"], _sale_sums(), window, watermark)


def region_windows(sales: DataFrame, window: str = HALF_MINUTE, watermark: str = MINUTE) -> DataFrame:
    return _windows(completed(sales), ["region", "sector"], _sale_sums()[:2], window, watermark)


def company_windows(sales: DataFrame, window: str = MINUTE, watermark: str = TWO_MINUTES) -> DataFrame:
    done = known(completed(sales), "companyId", "sector")
    return _windows(done, ["companyId", "sector"], _sale_sums(), window, watermark)


def market_windows(sales: DataFrame, window: str = MINUTE, watermark: str = MINUTE) -> DataFrame:
    """Two steps: per company, then per sector.

    The companies of a sector are counted exactly without collecting them; the ids themselves are the
    rows of ``market_members``.
    """
    slot = F.window("saleTime", window).alias("w")
    per_company = _timed(completed(sales), watermark).groupBy(slot, "sector", "companyId").agg(
        total("totalAmount").alias("money"), F.count("*").alias("n"))
    sums = per_company.groupBy("w", "sector").agg(
        total("money").alias("marketRevenue"), F.sum("n").alias("marketSalesCount"),
        F.try_divide(total("money"), F.sum("n")).alias("marketAvgSale"),
        F.count("companyId").alias("totalCompanies"))
    return _flat(sums)


def market_members(sales: DataFrame, window: str = MINUTE, watermark: str = MINUTE) -> DataFrame:
    """The set of companies that sold in each window of a sector, one row each."""
    return _windows(known(completed(sales), "companyId"), ["sector", "companyId"],
                    [F.count("*").alias("salesCount")], window, watermark)


def market_product_windows(items: DataFrame, products: DataFrame | None, window: str = MINUTE,
                           watermark: str = TWO_MINUTES) -> DataFrame:
    """Items of sales of any status."""
    sold = known(with_sector(items), "productId")
    return name_products(_product_windows(sold, ["productId", "sector"], window, watermark), products)


def company_product_windows(items: DataFrame, products: DataFrame | None, window: str = MINUTE,
                            watermark: str = TWO_MINUTES) -> DataFrame:
    """Items of sales of any status."""
    sold = known(items, "productId", "companyId", "sector")
    keys = ["productId", "companyId", "sector"]
    return name_products(_product_windows(sold, keys, window, watermark), products)


def market_brand_windows(items: DataFrame, products: DataFrame | None, window: str = MINUTE,
                         watermark: str = TWO_MINUTES, exact: bool = False) -> DataFrame:
    """Items of sales of any status, by the product's brand.

    Distinct products are estimated (a stream keeps a sketch of fixed size); ``exact`` counts them in batch.
    """
    sold = with_brand(enrich_items(with_sector(items), products))
    distinct = F.count_distinct("productId") if exact else F.approx_count_distinct("productId")
    return _windows(sold, ["brand", "sector"],
                    [total("subtotal").alias("totalRevenue"), distinct.alias("productCount")], window, watermark)


def market_employee_windows(sales: DataFrame, window: str = MINUTE, watermark: str = TWO_MINUTES,
                            exact: bool = False) -> DataFrame:
    distinct = F.count_distinct("employeeId") if exact else F.approx_count_distinct("employeeId")
    sums = [mean("totalAmount").alias("avgSaleAmount"), total("totalAmount").alias("revenue"),
            F.count("*").alias("totalSales"), distinct.alias("totalEmployees")]
    return _windows(completed(sales), ["sector"], sums, window, watermark)


SALTS = 16  # keys over which the lines of a hot sale are dealt


def salted(df: DataFrame, key: str, hot: DataFrame | None, spread: Column, name: str, salts: int = SALTS) -> DataFrame:
    """``df`` with a salt: 0 for most keys, the hash of ``spread`` for the rows of ``hot`` ones.

    ``hot`` has fewer than k keys of ``sketch.heavy_hitters`` (of an earlier batch or the stored facts), a bound that does
    not grow with the data.
    """
    if hot is None:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    marked = df.join(F.broadcast(hot.select(F.col(key).alias("__hot")).distinct()), F.col(key) == F.col("__hot"), "left")
    return marked.withColumn(name, F.when(F.col("__hot").isNotNull(), F.pmod(spread, F.lit(salts))).otherwise(0)
                             .cast("bigint")).drop("__hot")


def join_items_sales(items: DataFrame, sales: DataFrame, bound: str = TWO_MINUTES,
                     watermark: str = TWO_MINUTES, hot: DataFrame | None = None, how: str = "inner",
                     more: Sequence[str] = ()) -> DataFrame:
    """Items with the completed sale they belong to: branded ones under the company of the sale, or (``how="left"``)
    all of them with that company as ``headCompany``, null where there is none. ``more`` are further columns of the sale.

    Both sides have a watermark and the times must lie within ``bound`` of each other, so old state is
    dropped. Streams have no run-time skew handling: the lines of a sale that is known to be ``hot`` (saleId) are spread
    over SALTS keys, and its sale row is repeated for each; any other sale is one row of state. A stream is restarted
    with another list only on a new checkpoint, else sales of the last ``bound`` miss their later lines.
    """
    inner = how == "inner"
    lines = _timed(with_brand(with_sector(items)).drop("companyId") if inner else items, watermark)
    lines = salted(lines, "saleId", hot, F.xxhash64("productId", "quantity", "price"), "salt")
    heads = _timed(completed(sales), watermark).select(
        F.col("saleId").alias("headId"), F.col("saleTime").alias("headTime"),
        F.col("companyId").alias("companyId" if inner else "headCompany"), *more)
    if hot is None:
        heads = heads.withColumn("headSalt", F.lit(0).cast("bigint"))
    else:
        heads = salted(heads, "headId", hot.withColumnRenamed("saleId", "headId"), F.lit(SALTS - 1), "last").withColumn(
            "headSalt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))).drop("last")
    near = F.expr(f"saleTime >= headTime - INTERVAL {bound} AND saleTime <= headTime + INTERVAL {bound}")
    same = (F.col("saleId") == F.col("headId")) & (F.col("salt") == F.col("headSalt"))
    return lines.join(heads, same & near, how).drop("headId", "headTime", "headSalt", "salt")


def company_brand_windows(items: DataFrame, sales: DataFrame, products: DataFrame | None, window: str = MINUTE,
                          watermark: str = TWO_MINUTES, bound: str = TWO_MINUTES,
                          hot: DataFrame | None = None) -> DataFrame:
    """Two steps: lines are added up by product and their own brand, then the products are looked up and added up."""
    joined = known(join_items_sales(items, sales, bound, watermark, hot), "companyId")
    slot = F.window("saleTime", window).alias("w")
    sold = joined.groupBy(slot, "companyId", "sector", "brand", "productId").agg(
        total("subtotal").alias("subtotal"), F.sum("quantity").alias("quantity"), F.count("*").alias("lines"))
    rows = with_brand(enrich_items(sold, products))
    price, priced = F.col("productPrice"), F.col("productPrice").isNotNull()
    sums = [total("subtotal").alias("revenue"), F.sum("quantity").alias("quantity"),
            F.min("productName").alias("productName"),
            F.try_divide(total(price * F.col("lines")), F.sum(F.when(priced, F.col("lines")))).alias("avgPrice"),
            F.coalesce(total(price * F.col("quantity")), F.lit(0.0)).alias("listWorth"),
            F.coalesce(F.sum(F.when(priced, F.col("quantity"))), F.lit(0)).alias("pricedQuantity")]
    return _flat(rows.groupBy("w", "companyId", "sector", "brand").agg(*sums))


def company_employee_windows(sales: DataFrame, employees: DataFrame | None, window: str = MINUTE,
                             watermark: str = TWO_MINUTES) -> DataFrame:
    """employeeName is null for an employee missing from the dimension; the table makes up a name."""
    done = known(has_employee(completed(sales)), "companyId")
    sums = _windows(done, ["companyId", "sector", "employeeId"], _sale_sums(), window, watermark)
    return enrich_sales(sums, employees).drop("position")
