"""Sales, items and dimensions derived from the star-schema tables.

``v_sales``/``v_items`` come from orders and line items (day precision, 25 companies in 5 sectors);
``v_ev_*`` come from the event table (microseconds, 11 companies with one sector and region each).
Dimensions are whole. Some facts have keys that no dimension row has: products of every 40th part and employees of every
30th customer are negative, and a category is not listed.
VIEWS holds the same definitions as SQL for the independent check.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def unknown(key: Column, every: int) -> Column:
    """The key, but a negative one, which no dimension has, for each ``every``-th."""
    return F.when(key % every == 0, -key).otherwise(key)


def sales_of_events(events: DataFrame) -> DataFrame:
    """Works on the table and on a stream of it."""
    slot = F.col("user_id") % 11
    number = lambda first: F.concat(F.lit("_00"), (slot - first).cast("string"))
    return events.select(
        F.col("event_id").alias("saleId"), F.col("ts").alias("saleTime"),
        F.col("value").alias("totalAmount"),
        F.when(slot < 4, F.concat(F.lit("pharmacy"), number(-1)))
        .when(slot < 8, F.concat(F.lit("mall"), number(3)))
        .otherwise(F.concat(F.lit("distribution"), number(7))).alias("companyId"),
        F.concat(F.lit("branch_00"), (F.col("event_id") % 5 + 1).cast("string")).alias("branchId"),
        F.when(slot.isin(0, 1, 4, 5, 8), "north westbank").when(slot.isin(2, 6, 9), "south westbank")
        .otherwise("gaza").alias("region"),
        F.when(slot < 4, "pharmacy").when(slot < 8, "mall").otherwise("distribution").alias("sector"),
        F.when(slot < 4, "pharmacy").when(slot < 8, "retail").otherwise("distribution").alias("saleType"),
        F.when(F.col("event_type") == "error", "cancelled").when(F.col("event_type") == "view", "pending")
        .otherwise("completed").alias("saleStatus"),
        F.when(F.col("event_id") % 20 != 0, unknown(F.col("user_id"), 30)).alias("employeeId"),
        (F.col("user_id") % 50).alias("clientId"))


def items_of_sales(sales: DataFrame, part: DataFrame) -> DataFrame:
    """One to three lines per event sale."""
    line = F.explode(F.sequence(F.lit(1), (F.col("saleId") % 3 + 1).cast("int"))).alias("line")
    lines = sales.select("saleId", "sector", "companyId", "saleTime", line)
    price = F.col("saleId") * 13 + F.col("line") * 7
    quantity = (F.col("saleId") + F.col("line")) % 3 + 1
    keyed = lines.select(
        "saleId", ((F.col("saleId") * 7 + F.col("line")) % 200).alias("productId"),
        quantity.cast("int").alias("quantity"), (price % 200 + 1).cast("double").alias("price"),
        (quantity * (price % 200 + 1)).cast("double").alias("subtotal"),
        "sector", "companyId", "saleTime")
    brands = part.select(F.col("p_partkey").alias("productId"), F.col("p_brand").alias("brand"))
    return keyed.join(brands, "productId").withColumn("productId", unknown(F.col("productId"), 40))


class Tables:
    """Lazily built inputs of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    @functools.cached_property
    def sales(self) -> DataFrame:
        nation = self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        customer = self.read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        orders = self.read("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        return orders.select(
            F.col("o_orderkey").alias("saleId"), F.col("o_orderdate").alias("saleTime"),
            F.col("o_totalprice").alias("totalAmount"),
            F.col("n_name").alias("companyId"),
            F.concat(F.lit("branch_00"), (F.col("o_custkey") % 5 + 1).cast("string")).alias("branchId"),
            F.col("r_name").alias("region"), F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("sector"), F.col("o_orderpriority").alias("saleType"),
            F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending")
            .otherwise("cancelled").alias("saleStatus"),
            F.when(F.col("o_orderkey") % 20 != 0, unknown(F.col("o_custkey"), 30)).alias("employeeId"),
            F.col("o_custkey").alias("clientId"))

    @functools.cached_property
    def items(self) -> DataFrame:
        lines = self.read("lineitem").join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.select(
            F.col("l_orderkey").alias("saleId"), unknown(F.col("l_partkey"), 40).alias("productId"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("subtotal"),
            F.when(F.col("l_partkey") % 25 != 0, F.col("p_brand")).alias("brand"),
            F.when(F.col("p_type") == "PROMO", "UNLISTED").otherwise(F.col("p_type")).alias("categoryId"))

    @functools.cached_property
    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("productId"),
            F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("productName"),
            F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("productPrice"),
            F.col("p_type").alias("categoryId"), (F.col("p_size") % 10 != 0).alias("isActive"),
            F.concat(F.lit("SKU"), F.col("p_partkey").cast("string")).alias("sku"))

    @functools.cached_property
    def categories(self) -> DataFrame:
        return self.read("part").select(F.col("p_type").alias("categoryId"), F.lower("p_type").alias("categoryName")).distinct()

    @functools.cached_property
    def employees(self) -> DataFrame:
        return self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("employeeId"), F.col("c_name").alias("employeeName"),
            F.col("c_mktsegment").alias("position"), F.col("n_name").alias("companyId"),
            (F.col("c_acctbal") >= 0).alias("isActive"))

    @functools.cached_property
    def clients(self) -> DataFrame:
        nation = self.read("nation").join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("clientId"), F.col("c_name").alias("clientName"),
            F.col("r_name").alias("region"), F.col("n_name").alias("city"), F.col("n_name").alias("companyId"))

    @functools.cached_property
    def payments(self) -> DataFrame:
        kind, status = F.col("o_orderkey") % 5, F.col("o_orderstatus")
        return self.read("orders").select(
            F.col("o_orderkey").alias("saleId"), F.col("o_totalprice").alias("paymentAmount"),
            F.when(kind == 0, "cash").when(kind == 1, "cheque").when(kind == 2, "card")
            .when(kind == 3, "bank_transfer").otherwise("other").alias("paymentType"),
            F.when(status == "F", "completed").when(status == "O", "pending").otherwise("refunded")
            .alias("paymentStatus"),
            F.col("o_orderdate").alias("paymentDate"))

    @functools.cached_property
    def ev_sales(self) -> DataFrame:
        return sales_of_events(self.read("events"))

    @functools.cached_property
    def ev_items(self) -> DataFrame:
        return items_of_sales(self.ev_sales, self.read("part"))

    @functools.cached_property
    def placed_items(self) -> DataFrame:
        """Items carrying company, sector and time of their sale, as item messages do."""
        from salesloom.operators.joins import items_with_sale
        return items_with_sale(self.items, self.sales, ["companyId", "sector", "saleTime"])

    def shops(self) -> Tables:
        """The same data with every client as a company of its own, and categories as brands.

        Small companies differ more from their market, so more rules find something.
        """
        other = Tables(self.spark, self.folder)
        other.sales = self.sales.withColumn("companyId", F.col("clientId").cast("string"))
        other.items = self.items.withColumn("brand", F.col("categoryId"))
        other.products = self.products.withColumn("brand", F.col("categoryId"))
        return other


VIEWS = {
    "v_sales": """
SELECT o.o_orderkey AS saleId, o.o_orderdate AS saleTime, CAST(o.o_totalprice AS DECIMAL(18,2)) AS totalAmount,
       n.n_name AS companyId, concat('branch_00', CAST(o.o_custkey % 5 + 1 AS STRING)) AS branchId,
       r.r_name AS region, n.n_name AS city, c.c_mktsegment AS sector, o.o_orderpriority AS saleType,
       CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS saleStatus,
       CASE WHEN o.o_orderkey % 20 = 0 THEN NULL WHEN o.o_custkey % 30 = 0 THEN -o.o_custkey ELSE o.o_custkey END AS employeeId,
       o.o_custkey AS clientId
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_items": """
SELECT l.l_orderkey AS saleId, CASE WHEN l.l_partkey % 40 = 0 THEN -l.l_partkey ELSE l.l_partkey END AS productId, CAST(l.l_quantity AS INT) AS quantity,
       l.l_extendedprice / l.l_quantity AS price,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS subtotal,
       CASE WHEN l.l_partkey % 25 = 0 THEN NULL ELSE p.p_brand END AS brand,
       CASE WHEN p.p_type = 'PROMO' THEN 'UNLISTED' ELSE p.p_type END AS categoryId
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "v_products": """
SELECT p_partkey AS productId, concat(p_name, ' ', CAST(p_partkey AS STRING)) AS productName, p_brand AS brand,
       p_retailprice AS productPrice, p_type AS categoryId, p_size % 10 <> 0 AS isActive,
       concat('SKU', CAST(p_partkey AS STRING)) AS sku
FROM part""",
    "v_categories": """
SELECT DISTINCT p_type AS categoryId, lower(p_type) AS categoryName FROM part""",
    "v_employees": """
SELECT c.c_custkey AS employeeId, c.c_name AS employeeName, c.c_mktsegment AS position, n.n_name AS companyId,
       c.c_acctbal >= 0 AS isActive
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "v_clients": """
SELECT c.c_custkey AS clientId, c.c_name AS clientName, r.r_name AS region, n.n_name AS city, n.n_name AS companyId
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_payments": """
SELECT o_orderkey AS saleId, CAST(o_totalprice AS DECIMAL(18,2)) AS paymentAmount,
       CASE o_orderkey % 5 WHEN 0 THEN 'cash' WHEN 1 THEN 'cheque' WHEN 2 THEN 'card' WHEN 3 THEN 'bank_transfer' ELSE 'other' END AS paymentType,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'refunded' END AS paymentStatus,
       o_orderdate AS paymentDate
FROM orders""",
    "v_ev_sales": """
SELECT event_id AS saleId, ts AS saleTime, CAST(value AS DECIMAL(18,2)) AS totalAmount,
       CASE WHEN user_id % 11 < 4 THEN concat('pharmacy_00', CAST(user_id % 11 + 1 AS STRING))
            WHEN user_id % 11 < 8 THEN concat('mall_00', CAST(user_id % 11 - 3 AS STRING))
            ELSE concat('distribution_00', CAST(user_id % 11 - 7 AS STRING)) END AS companyId,
       concat('branch_00', CAST(event_id % 5 + 1 AS STRING)) AS branchId,
       CASE WHEN user_id % 11 IN (0, 1, 4, 5, 8) THEN 'north westbank'
            WHEN user_id % 11 IN (2, 6, 9) THEN 'south westbank' ELSE 'gaza' END AS region,
       CASE WHEN user_id % 11 < 4 THEN 'pharmacy' WHEN user_id % 11 < 8 THEN 'mall' ELSE 'distribution' END AS sector,
       CASE WHEN user_id % 11 < 4 THEN 'pharmacy' WHEN user_id % 11 < 8 THEN 'retail' ELSE 'distribution' END AS saleType,
       CASE event_type WHEN 'error' THEN 'cancelled' WHEN 'view' THEN 'pending' ELSE 'completed' END AS saleStatus,
       CASE WHEN event_id % 20 = 0 THEN NULL WHEN user_id % 30 = 0 THEN -user_id ELSE user_id END AS employeeId,
       user_id % 50 AS clientId
FROM events""",
    "v_ev_items": """
SELECT s.saleId, CASE WHEN p.p_partkey % 40 = 0 THEN -p.p_partkey ELSE p.p_partkey END AS productId, CAST(1 + (s.saleId + k.line) % 3 AS INT) AS quantity,
       CAST(1 + (s.saleId * 13 + k.line * 7) % 200 AS DOUBLE) AS price,
       CAST((1 + (s.saleId + k.line) % 3) * (1 + (s.saleId * 13 + k.line * 7) % 200) AS DECIMAL(18,4)) AS subtotal,
       s.sector, s.companyId, s.saleTime, p.p_brand AS brand
FROM v_ev_sales s JOIN (VALUES (1), (2), (3)) k(line) ON k.line <= 1 + s.saleId % 3
JOIN part p ON p.p_partkey = (s.saleId * 7 + k.line) % 200""",
    # Result tables, for the questions asked of them.
    "t_company": """
SELECT companyId, sector, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount,
       CAST(sum(totalAmount) AS DOUBLE) / count(*) AS avgSaleAmount
FROM v_sales WHERE saleStatus = 'completed' GROUP BY companyId, sector""",
    "t_market": """
SELECT sector, CAST(sum(totalAmount) AS DOUBLE) AS marketRevenue, count(*) AS marketSalesCount,
       CAST(sum(totalAmount) AS DOUBLE) / count(*) AS marketAvgSale, count(DISTINCT companyId) AS totalCompanies
FROM v_sales WHERE saleStatus = 'completed' GROUP BY sector""",
    "t_region": """
SELECT region, sector, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount
FROM v_sales WHERE saleStatus = 'completed' GROUP BY region, sector""",
    "v_placed": """
SELECT i.*, s.companyId, s.sector, s.saleTime, s.saleStatus FROM v_items i JOIN v_sales s ON s.saleId = i.saleId""",
    "t_company_products": """
SELECT companyId, sector, i.productId, min(p.productName) AS productName, min(coalesce(p.brand, i.brand)) AS brand,
       CAST(sum(subtotal) AS DOUBLE) AS totalRevenue, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       CAST(sum(subtotal) AS DOUBLE) / sum(quantity) AS avgPrice
FROM v_placed i LEFT JOIN v_products p ON p.productId = i.productId GROUP BY companyId, sector, i.productId""",
    "t_market_products": """
SELECT sector, i.productId, min(p.productName) AS productName, min(coalesce(p.brand, i.brand)) AS brand,
       CAST(sum(subtotal) AS DOUBLE) AS totalRevenue, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       CAST(sum(subtotal) AS DOUBLE) / sum(quantity) AS avgPrice
FROM v_placed i LEFT JOIN v_products p ON p.productId = i.productId GROUP BY sector, i.productId""",
    "v_branded": """
SELECT i.companyId, i.sector, i.productId, coalesce(p.brand, i.brand) AS brand, i.subtotal, i.quantity, p.productPrice
FROM v_placed i LEFT JOIN v_products p ON p.productId = i.productId
WHERE i.saleStatus = 'completed' AND i.brand <> ''""",
    "t_brands_all": """
SELECT companyId, sector, brand, CAST(sum(subtotal) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(CAST(productPrice AS DECIMAL(14,2)) * quantity) AS DOUBLE)
         / sum(CASE WHEN productPrice IS NOT NULL THEN quantity END) AS avgPrice
FROM v_branded GROUP BY companyId, sector, brand""",
    "t_brands": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY companyId, sector ORDER BY revenue DESC, brand) AS rank
FROM t_brands_all) WHERE rank <= 5""",
    "t_market_brands": """
SELECT b.sector, b.brand, b.totalRevenue, b.maxQuantity, c.productCount
FROM (SELECT sector, brand, sum(CAST(revenue AS DECIMAL(28,4)))::DOUBLE AS totalRevenue, max(quantity) AS maxQuantity
      FROM t_brands_all GROUP BY sector, brand) b
JOIN (SELECT sector, brand, count(DISTINCT productId) AS productCount FROM v_branded GROUP BY sector, brand) c
  ON c.sector = b.sector AND c.brand = b.brand""",
    "t_employees": """
SELECT a.companyId, a.employeeId, a.sector,
       coalesce(e.employeeName, CASE WHEN length(CAST(a.employeeId AS STRING)) >= 4
         THEN concat('Employee ', right(CAST(a.employeeId AS STRING), 4)) ELSE 'Unknown Employee' END) AS employeeName,
       a.revenue, a.salesCount, a.avgSaleAmount
FROM (SELECT companyId, employeeId, min(sector) AS sector, CAST(sum(totalAmount) AS DOUBLE) AS revenue,
             count(*) AS salesCount, CAST(sum(totalAmount) AS DOUBLE) / count(*) AS avgSaleAmount
      FROM v_sales WHERE saleStatus = 'completed' AND employeeId IS NOT NULL GROUP BY companyId, employeeId) a
LEFT JOIN v_employees e ON e.employeeId = a.employeeId""",
    "t_market_employees": """
SELECT sector, sum(CAST(revenue AS DECIMAL(28,4)))::DOUBLE / sum(salesCount) AS avgSaleAmount,
       CAST(sum(salesCount) AS BIGINT) AS totalSales, count(DISTINCT employeeId) AS totalEmployees
FROM t_employees GROUP BY sector""",
    "t_gaps": """
SELECT *, CASE WHEN marketAvg > 0 THEN (revenue - marketAvg) / marketAvg * 100 ELSE 0 END AS revenueDiff,
       CASE WHEN marketAvgSale > 0 THEN (avgSaleAmount - marketAvgSale) / marketAvgSale * 100 ELSE 0 END AS avgSaleDiff,
       CASE WHEN marketAvgSalesCount > 0 THEN (salesCount - marketAvgSalesCount) / marketAvgSalesCount * 100 ELSE 0 END AS salesCountDiff,
       revenue > 0 AND marketAvg > 0 AND revenue < marketAvg AS hasRevenueProblem
FROM (SELECT c.companyId, c.sector, c.revenue, c.salesCount, c.avgSaleAmount, m.marketRevenue, m.marketSalesCount,
             m.marketAvgSale, m.totalCompanies, m.marketRevenue / m.totalCompanies AS marketAvg,
             CAST(m.marketSalesCount AS DOUBLE) / m.totalCompanies AS marketAvgSalesCount
      FROM t_company c JOIN t_market m ON m.sector = c.sector)""",
}


def shop_sql(sql: str) -> str:
    """The statement asked of the shops: every view that depends on the sales is replaced by its twin."""
    return re.sub(r"\b([vt])_(sales|items|products|placed|branded|company\w*|market\w*|brands\w*|employees|gaps)\b",
                  lambda m: m[0] if m[0] == "v_employees" else f"{m[1]}_shop_{m[2]}", sql)


VIEWS.update({shop_sql(name): shop_sql(text) for name, text in VIEWS.items() if shop_sql(name) != name})
VIEWS.update({
    "v_shop_sales": "SELECT * REPLACE (CAST(clientId AS STRING) AS companyId) FROM v_sales",
    "v_shop_items": "SELECT * REPLACE (categoryId AS brand) FROM v_items",
    "v_shop_products": "SELECT * REPLACE (categoryId AS brand) FROM v_products",
})


def with_views(sql: str) -> str:
    """The statement with the views it uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[vt]_\w+", text)):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    body = sql.strip()
    return f"WITH {views}{',' if body.upper().startswith('WITH ') else ''}\n" + (
        body[5:] if body.upper().startswith("WITH ") else body)
