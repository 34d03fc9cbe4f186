"""Windowed streams: batch twins, streamed results through the ledger, and streaming-only steps."""

from __future__ import annotations

import contextlib
import datetime
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.catalog.bindings import Tables, items_of_sales, sales_of_events
from salesloom.catalog.registry import query
from salesloom.functions.measures import total
from salesloom.operators import sketch
from salesloom.plans import tables as t
from salesloom.session import work_folder
from salesloom.sources import events as ev
from salesloom.streaming import runner
from salesloom.streaming import windowed as w
from salesloom.streaming.dedup import dedup_events
from salesloom.streaming.ledger import live_table, live_windows, write_batch

# The events lie minutes apart, so windows are wide here; the tests cover the defaults.
SLOT = {"window": "1 hour", "watermark": "2 hours"}


def plain_times(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))


def event_stream(b: Tables, flush: bool) -> DataFrame:
    """The event table as a file stream.

    ``flush`` adds one event far in the future, which closes the last real window of an append query
    (its own window never closes).
    """
    schema = b.read("events").schema
    events = b.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(b.folder)
    if not flush:
        return events
    folder = work_folder(b.spark, "flush")
    far = datetime.datetime(2099, 1, 1)
    b.spark.createDataFrame([(2, far, 0, "click", 1.0, None)], schema).write.parquet(folder)
    return events.unionByName(b.spark.readStream.schema(schema).parquet(folder))


@contextlib.contextmanager
def few_stores(spark: SparkSession):
    """One state store per shuffle partition and operator: a local run needs few. The setting is put back."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        if spark.conf.get("spark.master", "").startswith("local"):
            spark.conf.set(key, min(int(before), os.cpu_count() or 8))
        yield
    finally:
        spark.conf.set(key, before)


def inputs(b: Tables, flush: bool) -> runner.Inputs:
    sales = sales_of_events(event_stream(b, flush))
    items = items_of_sales(sales_of_events(event_stream(b, flush)), b.read("part"))
    return runner.Inputs(sales, items, b.products, b.employees)


def streamed(b: Tables, name: str) -> DataFrame:
    """Run one stream over all events and read its windows from the ledger."""
    spec = runner.BY_NAME[name]
    root = work_folder(b.spark, "stream")
    options = {**SLOT, **({"bound": "2 minutes"} if name == "company_brands" else {})}
    with few_stores(b.spark):
        runner.start(spec, inputs(b, spec.mode == "append"), root, once=True, **options).awaitTermination()
    return plain_times(live_windows(b.spark, f"{root}/{name}", spec.columns))


HOUR = "time_bucket(INTERVAL 1 HOUR, saleTime) AS window_start, time_bucket(INTERVAL 1 HOUR, saleTime) + INTERVAL 1 HOUR AS window_end"
SALE = ("CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount, "
        "six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS avgSaleAmount")
DONE = "FROM v_ev_sales WHERE saleStatus = 'completed'"
SECTOR = f"SELECT {HOUR}, sector, {SALE} {DONE} GROUP BY ALL"
REGION = f"""SELECT {HOUR}, region, sector, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount
{DONE} GROUP BY ALL"""
COMPANY = f"SELECT {HOUR}, companyId, sector, {SALE} {DONE} GROUP BY ALL"
MARKET = f"""SELECT {HOUR}, sector, CAST(sum(totalAmount) AS DOUBLE) AS marketRevenue, count(*) AS marketSalesCount,
       six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS marketAvgSale, count(DISTINCT companyId) AS totalCompanies
{DONE} GROUP BY ALL"""
PRODUCT = """CAST(sum(subtotal) AS DOUBLE) AS totalRevenue, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       min(coalesce(p.brand, i.brand)) AS brand, six(avg(price)) AS avgPrice, min(p.productName) AS productName
FROM v_ev_items i LEFT JOIN v_products p ON p.productId = i.productId"""
MARKET_PRODUCTS = f"SELECT {HOUR}, i.productId, sector, {PRODUCT} GROUP BY ALL"
COMPANY_PRODUCTS = f"SELECT {HOUR}, i.productId, companyId, sector, {PRODUCT} GROUP BY ALL"
MARKET_BRANDS = f"""
SELECT {HOUR}, coalesce(p.brand, i.brand) AS brand, sector, CAST(sum(subtotal) AS DOUBLE) AS totalRevenue,
       count(DISTINCT i.productId) AS productCount
FROM v_ev_items i LEFT JOIN v_products p ON p.productId = i.productId GROUP BY ALL"""
MARKET_EMPLOYEES = f"""
SELECT {HOUR}, sector, six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS avgSaleAmount,
       CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS totalSales, count(DISTINCT employeeId) AS totalEmployees
{DONE} GROUP BY ALL"""
COMPANY_BRANDS = f"""
SELECT time_bucket(INTERVAL 1 HOUR, i.saleTime) AS window_start,
       time_bucket(INTERVAL 1 HOUR, i.saleTime) + INTERVAL 1 HOUR AS window_end, s.companyId, i.sector,
       coalesce(p.brand, i.brand) AS brand, CAST(sum(subtotal) AS DOUBLE) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS quantity, min(p.productName) AS productName, six(avg(p.productPrice)) AS avgPrice,
       CAST(coalesce(sum(CAST(p.productPrice AS DECIMAL(14,2)) * quantity), 0) AS DOUBLE) AS listWorth,
       CAST(coalesce(sum(CASE WHEN p.productPrice IS NOT NULL THEN quantity END), 0) AS BIGINT) AS pricedQuantity
FROM v_ev_items i JOIN v_ev_sales s ON s.saleId = i.saleId AND s.saleStatus = 'completed'
LEFT JOIN v_products p ON p.productId = i.productId WHERE i.brand <> '' GROUP BY ALL"""
COMPANY_EMPLOYEES = f"""
SELECT {HOUR}, s.companyId, sector, s.employeeId, {SALE}, e.employeeName
FROM v_ev_sales s LEFT JOIN v_employees e ON e.employeeId = s.employeeId
WHERE saleStatus = 'completed' AND s.employeeId IS NOT NULL GROUP BY ALL"""


# Batch twins: the functions the streams run, on static tables.
@query("st01_sector_windows", SECTOR)
def _(b): return plain_times(w.sector_windows(b.ev_sales, **SLOT))


@query("st02_region_windows", REGION)
def _(b): return plain_times(w.region_windows(b.ev_sales, **SLOT))


@query("st03_market_product_windows", MARKET_PRODUCTS)
def _(b): return plain_times(w.market_product_windows(b.ev_items, b.products, **SLOT))


@query("st04_company_product_windows", COMPANY_PRODUCTS)
def _(b): return plain_times(w.company_product_windows(b.ev_items, b.products, **SLOT))


@query("st05_market_brand_windows", MARKET_BRANDS)
def _(b): return plain_times(w.market_brand_windows(b.ev_items, b.products, exact=True, **SLOT))


@query("st06_market_employee_windows", MARKET_EMPLOYEES)
def _(b): return plain_times(w.market_employee_windows(b.ev_sales, exact=True, **SLOT))


@query("st07_company_windows", COMPANY)
def _(b): return plain_times(w.company_windows(b.ev_sales, **SLOT))


@query("st08_market_windows", MARKET)
def _(b): return plain_times(w.market_windows(b.ev_sales, **SLOT))


@query("st08_market_members", f"SELECT {HOUR}, sector, companyId, count(*) AS salesCount {DONE} GROUP BY ALL")
def _(b): return plain_times(w.market_members(b.ev_sales, **SLOT))


@query("st09_company_brand_windows", COMPANY_BRANDS)
def _(b): return plain_times(w.company_brand_windows(b.ev_items, b.ev_sales, b.products, **SLOT))


@query("st10_company_employee_windows", COMPANY_EMPLOYEES)
def _(b): return plain_times(w.company_employee_windows(b.ev_sales, b.employees, **SLOT))


# The same through Structured Streaming and the ledger.
@query("st01_sector_stream", SECTOR)
def _(b): return streamed(b, "sector")


@query("st02_region_stream", REGION)
def _(b): return streamed(b, "region")


@query("st03_market_product_stream", MARKET_PRODUCTS)
def _(b): return streamed(b, "market_products")


@query("st04_company_product_stream", COMPANY_PRODUCTS)
def _(b): return streamed(b, "company_products")


@query("st05_market_brand_stream", f"SELECT * EXCLUDE (productCount) FROM ({MARKET_BRANDS})")
def _(b): return streamed(b, "market_brands").drop("productCount")


@query("st06_market_employee_stream", f"SELECT * EXCLUDE (totalEmployees) FROM ({MARKET_EMPLOYEES})")
def _(b): return streamed(b, "market_employees").drop("totalEmployees")


@query("st07_company_stream", COMPANY)
def _(b): return streamed(b, "company")


@query("st08_market_stream", MARKET)
def _(b): return streamed(b, "market")


@query("st09_company_brand_stream", COMPANY_BRANDS)
def _(b): return streamed(b, "company_brands")


@query("st10_company_employee_stream", COMPANY_EMPLOYEES)
def _(b): return streamed(b, "company_employees")


# Result tables kept by two streams, one over sales and one over items with their sales.
def closed_inputs(b: Tables) -> runner.Inputs:
    """The inputs with a last sale and a last item far in the future.

    They let the join give out items without a sale. The item has no product and no brand, so no table takes it.
    """
    far = F.lit(datetime.datetime(2099, 1, 1)).cast("timestamp")

    def closed(df: DataFrame, **values) -> DataFrame:
        folder = work_folder(b.spark, "flush")
        last = {"saleTime": far, "saleId": F.lit(-1), "productId": F.lit(None), **values}
        b.spark.range(1).select(*[last.get(c, F.lit("" if kind == "string" else 0)).cast(kind).alias(c)
                                  for c, kind in df.dtypes]).write.parquet(folder)
        return df.unionByName(b.spark.readStream.schema(df.schema).parquet(folder))

    plain = inputs(b, False)
    return runner.Inputs(closed(plain.sales, saleStatus=F.lit("completed")), closed(plain.items), b.products, b.employees)


def kept_root(b: Tables, *of: str) -> str:
    root = work_folder(b.spark, "kept")
    with few_stores(b.spark):
        for name in of:
            ins = closed_inputs(b) if name == "items" else inputs(b, False)
            for stream in runner.start_kept(ins, root, True, [name], watermark=SLOT["watermark"], parts=2):
                stream.awaitTermination()
    return root


def kept(b: Tables, table: str, of: str) -> DataFrame:
    return runner.result_tables(b.spark, kept_root(b, of), b.products, b.employees)[table]()


def close(estimate: str, exact: str):
    """Whether a merged sketch lies within three standard errors (1.6 % each) of the exact count."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * 0.05


@query("st01_sales_by_sector_kept", f"SELECT sector, {SALE} {DONE} GROUP BY sector")
def _(b): return kept(b, "sales_by_sector", "sales")


@query("st02_sales_by_region_kept", f"""
SELECT region, sector, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount {DONE} GROUP BY region, sector""")
def _(b): return kept(b, "sales_by_region", "sales")


KEPT_PRODUCTS = """
SELECT sector, {} i.productId, min(p.productName) AS productName, min(coalesce(p.brand, i.brand)) AS brand,
       CAST(sum(subtotal) AS DOUBLE) AS totalRevenue, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       six(CAST(sum(subtotal) AS DOUBLE) / sum(quantity)) AS avgPrice
FROM v_ev_items i LEFT JOIN v_products p ON p.productId = i.productId GROUP BY ALL"""


@query("st03_market_top_products_kept", KEPT_PRODUCTS.format(""))
def _(b): return kept(b, "market_top_products", "items")


@query("st04_company_top_products_kept", KEPT_PRODUCTS.format("companyId,"))
def _(b): return kept(b, "company_top_products", "items")


KEPT_BRANDS = f"""
SELECT companyId, sector, brand, sum(CAST(revenue AS DECIMAL(28,4)))::DOUBLE AS revenue,
       CAST(sum(quantity) AS BIGINT) AS quantity,
       six(sum(CAST(listWorth AS DECIMAL(28,4)))::DOUBLE / sum(pricedQuantity)) AS avgPrice
FROM ({COMPANY_BRANDS}) GROUP BY companyId, sector, brand"""


@query("st05_market_top_brands_kept", f"""
SELECT b.*, p.productCount, TRUE AS countIsClose
FROM (SELECT sector, brand, sum(CAST(revenue AS DECIMAL(28,4)))::DOUBLE AS totalRevenue, max(quantity) AS maxQuantity
      FROM ({KEPT_BRANDS}) GROUP BY sector, brand) b
JOIN (SELECT i.sector, coalesce(p.brand, i.brand) AS brand, count(DISTINCT i.productId) AS productCount
      FROM v_ev_items i JOIN v_ev_sales s ON s.saleId = i.saleId AND s.saleStatus = 'completed'
      LEFT JOIN v_products p ON p.productId = i.productId WHERE i.brand <> '' GROUP BY ALL) p
  ON p.sector = b.sector AND p.brand = b.brand""")
def _(b):
    """The sketch's count is compared with the exact one, which the row shows."""
    exact = t.branded_items(b.ev_items, b.ev_sales, b.products).groupBy("sector", "brand").agg(
        F.count_distinct("productId").alias("exact"))
    rows = kept(b, "market_top_brands", "items").join(exact, ["sector", "brand"])
    return rows.select("sector", "brand", "totalRevenue", "maxQuantity", F.col("exact").alias("productCount"),
                       close("productCount", "exact").alias("countIsClose"))


@query("st06_market_employee_performance_kept", f"""
SELECT sector, six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS avgSaleAmount, count(*) AS totalSales,
       count(DISTINCT employeeId) AS totalEmployees, TRUE AS countIsClose {DONE} AND employeeId IS NOT NULL GROUP BY sector""")
def _(b):
    exact = t.market_employee_performance(t.company_employees(b.ev_sales, b.employees)).select(
        "sector", F.col("totalEmployees").alias("exact"))
    rows = kept(b, "market_employee_performance", "sales").join(exact, "sector")
    return rows.select("sector", "avgSaleAmount", "totalSales", F.col("exact").alias("totalEmployees"),
                       close("totalEmployees", "exact").alias("countIsClose"))


@query("st07_company_analytics_kept", f"SELECT companyId, sector, {SALE} {DONE} GROUP BY companyId, sector")
def _(b): return kept(b, "company_analytics", "sales")


@query("st08_market_analytics_kept", f"""
SELECT sector, CAST(sum(totalAmount) AS DOUBLE) AS marketRevenue, count(*) AS marketSalesCount,
       six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS marketAvgSale, count(DISTINCT companyId) AS totalCompanies
{DONE} GROUP BY sector""")
def _(b): return kept(b, "market_analytics", "sales")


@query("st09_company_brands_kept", f"""
SELECT * EXCLUDE (rank), CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER
  (PARTITION BY companyId, sector ORDER BY revenue DESC, brand) AS rank FROM ({KEPT_BRANDS})) WHERE rank <= 5""")
def _(b): return kept(b, "company_brands", "items")


@query("st10_company_employees_kept", f"""
SELECT s.companyId, s.employeeId, min(sector) AS sector,
       coalesce(min(e.employeeName), CASE WHEN length(CAST(s.employeeId AS STRING)) >= 4
         THEN concat('Employee ', right(CAST(s.employeeId AS STRING), 4)) ELSE 'Unknown Employee' END) AS employeeName, {SALE}
FROM v_ev_sales s LEFT JOIN v_employees e ON e.employeeId = s.employeeId
WHERE saleStatus = 'completed' AND s.employeeId IS NOT NULL GROUP BY s.companyId, s.employeeId""")
def _(b): return kept(b, "company_employees", "sales")


KEPT_PEOPLE = f"SELECT companyId, employeeId, sum(totalAmount) AS revenue {DONE} AND employeeId IS NOT NULL GROUP BY ALL"


@query("s08_ten_tables", f"""
WITH c AS (SELECT companyId, sector, sum(totalAmount) AS revenue {DONE} GROUP BY ALL),
r AS (SELECT region, sector, sum(totalAmount) AS revenue {DONE} GROUP BY ALL),
e AS ({KEPT_PEOPLE}),
p AS (SELECT companyId, sector, productId, sum(subtotal) AS revenue FROM v_ev_items GROUP BY ALL),
b AS ({KEPT_BRANDS}),
five AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY companyId, sector ORDER BY revenue DESC, brand) <= 5)
SELECT 'company_analytics' AS name, count(*) AS n, CAST(sum(revenue) AS DOUBLE) AS revenue FROM c
UNION ALL SELECT 'market_analytics', count(DISTINCT sector), CAST(sum(revenue) AS DOUBLE) FROM c
UNION ALL SELECT 'sales_by_sector', count(DISTINCT sector), CAST(sum(revenue) AS DOUBLE) FROM c
UNION ALL SELECT 'sales_by_region', count(*), CAST(sum(revenue) AS DOUBLE) FROM r
UNION ALL SELECT 'company_employees', count(*), CAST(sum(revenue) AS DOUBLE) FROM e
UNION ALL SELECT 'market_employee_performance', count(DISTINCT sector), CAST(sum(totalAmount) AS DOUBLE) {DONE}
  AND employeeId IS NOT NULL
UNION ALL SELECT 'company_top_products', count(*), CAST(sum(revenue) AS DOUBLE) FROM p
UNION ALL SELECT 'market_top_products', count(DISTINCT (sector, productId)), CAST(sum(revenue) AS DOUBLE) FROM p
UNION ALL SELECT 'company_brands', count(*), CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) FROM five
UNION ALL SELECT 'market_top_brands', count(DISTINCT (sector, brand)), CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) FROM b""")
def _(b):
    """All ten tables from two streams: rows and revenue of each."""
    found = runner.result_tables(b.spark, kept_root(b, "sales", "items"), b.products, b.employees)
    money = {"market_analytics": "marketRevenue", "market_employee_performance": F.col("avgSaleAmount") * F.col("totalSales"),
             **dict.fromkeys(("company_top_products", "market_top_products", "market_top_brands"), "totalRevenue")}
    out = None
    for name, table in found.items():
        row = table().agg(F.count("*").alias("n"), total(money.get(name, "revenue")).alias("revenue")).select(
            F.lit(name).alias("name"), "n", "revenue")
        out = row if out is None else out.unionByName(row)
    return out


# Ledger, de-duplication, join and sketch.
@query("s03_update_ledger", f"""
SELECT region, sector, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount {DONE} GROUP BY region, sector""")
def _(b):
    """The running values of every window are written twice, half finished and whole; only the last count."""
    spec = runner.BY_NAME["region"]
    root = work_folder(b.spark, "ledger")
    whole = w.region_windows(b.ev_sales, **SLOT)
    first = w.region_windows(b.ev_sales.filter(F.minute("saleTime") < 30), **SLOT)
    write_batch(first, 0, root)
    write_batch(whole, 1, root)
    write_batch(whole, 1, root)
    return live_table(b.spark, root, spec.columns)


@query("s04_dedup_events", "SELECT saleId, companyId, CAST(totalAmount AS DOUBLE) AS totalAmount FROM v_ev_sales")
def _(b):
    """Each sale comes again a minute later with another amount; the first one counts."""
    later = b.ev_sales.withColumns({"saleTime": F.col("saleTime") + F.expr("INTERVAL 1 MINUTE"),
                                    "totalAmount": (F.col("totalAmount") - 1).cast(dict(b.ev_sales.dtypes)["totalAmount"])})
    return dedup_events(later.unionByName(b.ev_sales), ["saleId"]).select(
        "saleId", "companyId", F.col("totalAmount").cast("double").alias("totalAmount"))


@query("s04_dedup_stream", "SELECT saleId, companyId, CAST(totalAmount AS DOUBLE) AS totalAmount FROM v_ev_sales")
def _(b):
    twice = [sales_of_events(event_stream(b, False)).withColumn("offset", F.lit(copy)) for copy in (0, 1)]
    hot = b.ev_sales.filter("saleId < 5").select("saleId")  # split like very frequent ids
    unique = dedup_events(twice[0].unionByName(twice[1]), ["saleId"], spread=F.col("offset"), hot=hot)
    root = work_folder(b.spark, "stream")
    rows = unique.select("saleId", "companyId", F.col("totalAmount").cast("double").alias("totalAmount"))
    with few_stores(b.spark):
        (rows.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).foreachBatch(lambda df, n: write_batch(df, n, root)).start().awaitTermination())
    return b.spark.read.parquet(f"{root}/batches").drop("batch_id")


@query("s05_topic_stats", """
SELECT 'payments' AS topic, count(*) AS consumed, 0::BIGINT AS duplicates, 0::BIGINT AS errors FROM v_payments
UNION ALL SELECT 'sales', 2 * count(*), CAST(count(*) AS BIGINT), 0 FROM v_ev_sales
UNION ALL SELECT 'sale_items', count(*), 0, count(*) FROM v_ev_items""")
def _(b):
    """Sales are sent twice; item messages are cut short, so none can be decoded."""
    at = "2024-06-01 00:00:00"
    sales = ev.to_events(b.ev_sales.withColumnRenamed("saleId", "_id"), "sale", at)
    items = ev.to_events(b.ev_items, "sale_item", at).withColumn("value", F.expr("left(value, length(value) - 9)"))
    payments = ev.to_events(b.payments.withColumn("_id", F.col("saleId")), "payment", at)
    return ev.topic_stats(sales.unionByName(sales).unionByName(items).unionByName(payments))


CELLS = """
SELECT CAST(r AS INT) AS row, CAST('0x' || substr(sha256(CAST(productId AS STRING)), 8 * r + 1, 8) AS BIGINT) % {width} AS bucket,
       {value} FROM {source}, (SELECT unnest(range({depth})) AS r)"""


@query("s06_cms_build", f"SELECT row, bucket, count(*) AS count FROM ("
       f"{CELLS.format(width=1000, depth=5, value='1 AS one', source='v_items')}) GROUP BY row, bucket")
def _(b): return sketch.cms_build(b.items, "productId", 1000, 5)


ESTIMATES = f"""
WITH sketch AS (SELECT row, bucket, count(*) AS count FROM ({CELLS.format(width=1000, depth=5, value='1 AS one', source='v_items')})
                GROUP BY row, bucket),
keys AS (SELECT DISTINCT productId FROM v_items)
SELECT c.productId, min(s.count) AS estimate
FROM ({CELLS.format(width=1000, depth=5, value='productId', source='keys')}) c
JOIN sketch s ON s.row = c.row AND s.bucket = c.bucket GROUP BY c.productId"""


@query("s06_cms_estimate", ESTIMATES)
def _(b): return sketch.cms_estimate(sketch.cms_build(b.items, "productId", 1000, 5), b.items, "productId", 1000, 5)


@query("s06_cms_merge", f"SELECT row, bucket, CAST(2 * count(*) AS BIGINT) AS count FROM ("
       f"{CELLS.format(width=1000, depth=5, value='1 AS one', source='v_items')}) GROUP BY row, bucket")
def _(b):
    one = sketch.cms_build(b.items, "productId", 1000, 5)
    return sketch.cms_merge(one, one)


@query("s07_cms_top_k", f"{ESTIMATES} ORDER BY estimate DESC, c.productId LIMIT 20")
def _(b): return sketch.cms_top_k(sketch.cms_build(b.items, "productId", 1000, 5), b.items, "productId", 20, 1000, 5)


@query("s07_heavy_hitters", """
SELECT companyId, CAST(n AS BIGINT) AS estimate FROM (SELECT companyId, count(*) AS n FROM v_ev_items GROUP BY companyId)
WHERE n * 11 > (SELECT count(*) FROM v_ev_items)""")
def _(b):
    """Companies with more than an eleventh of all items; the sketch is wide enough to count eleven keys exactly."""
    return sketch.heavy_hitters(b.ev_items, "companyId", 11)
