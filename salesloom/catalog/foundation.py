"""Sources, sinks, filters, joins, listings and ingestion."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import model
from salesloom.catalog.bindings import Tables, unknown
from salesloom.catalog.registry import query
from salesloom.functions import measures as m
from salesloom.functions import names
from salesloom.operators import filters as f
from salesloom.operators import ingest as ing
from salesloom.operators import joins as j
from salesloom.operators import listing as ls
from salesloom.operators import topk
from salesloom.operators import validate as v
from salesloom.operators.merge import merge_keyed
from salesloom.session import work_folder
from salesloom.sources import events as ev
from salesloom.sources import streams
from salesloom.sources import tables as stored
from salesloom.streaming import windowed as w
from salesloom.streaming.ledger import merge_additive, write_batch

AT = "2024-06-01 00:00:00"
SALE = "saleId, saleTime, CAST(totalAmount AS DOUBLE) AS totalAmount, companyId, branchId, region, sector, saleType, saleStatus"


def text(*columns: str) -> list[Column]:
    """Columns that may be null, compared as text."""
    return [F.col(c).cast("string").alias(c) for c in columns]


def sale(df: DataFrame) -> DataFrame:
    return df.select("saleId", "saleTime", F.col("totalAmount").cast("double").alias("totalAmount"), "companyId",
                     "branchId", "region", "sector", "saleType", "saleStatus")


def line(df: DataFrame, *more: str) -> DataFrame:
    return df.select("saleId", "productId", "quantity", F.col("subtotal").cast("double").alias("subtotal"), *more)


LINE = "i.saleId, i.productId, i.quantity, CAST(i.subtotal AS DOUBLE) AS subtotal"


# Sources and sinks.
def sale_messages(b: Tables) -> DataFrame:
    events = b.ev_sales.withColumn("saleTime", F.date_format("saleTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return ev.to_events(events.withColumnRenamed("saleId", "_id"), "sale", AT)


def item_messages(b: Tables) -> DataFrame:
    events = b.ev_items.withColumn("saleTime", F.date_format("saleTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return ev.to_events(events, "sale_item", AT)


def drained(b: Tables, stream: DataFrame) -> DataFrame:
    root = work_folder(b.spark, "stream")
    (stream.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).foreachBatch(lambda df, n: write_batch(df, n, root)).start().awaitTermination())
    return b.spark.read.parquet(f"{root}/batches").drop("batch_id")


def json_stream(b: Tables, messages: DataFrame) -> streams.StreamSource:
    folder = work_folder(b.spark, "messages")
    messages.select("value").write.text(folder)
    return streams.StreamSource("json", {"path": folder})


@query("src01_sales_stream", """
SELECT CAST(saleId AS STRING) AS saleId, saleTime, CAST(totalAmount AS DOUBLE) AS totalAmount, companyId, sector,
       saleStatus, 'sale.created' AS eventType FROM v_ev_sales""")
def _(b):
    rows = drained(b, streams.sales_stream(b.spark, json_stream(b, sale_messages(b))))
    return rows.select("saleId", F.col("saleTime").cast("timestamp_ntz").alias("saleTime"), "totalAmount", "companyId",
                       "sector", "saleStatus", "eventType")


@query("src02_items_stream", """
SELECT CAST(saleId AS STRING) AS saleId, CAST(productId AS STRING) AS productId, quantity, price,
       CAST(subtotal AS DOUBLE) AS subtotal, brand, 'sale_item.created' AS eventType FROM v_ev_items""")
def _(b):
    rows = drained(b, streams.items_stream(b.spark, json_stream(b, item_messages(b))))
    return rows.select("saleId", "productId", "quantity", "price", "subtotal", "brand", "eventType")


@query("src03_decode", """
SELECT CAST(saleId AS STRING) AS _id, CAST(totalAmount AS DOUBLE) AS totalAmount, companyId, region, sector, saleStatus,
       'sale.created' AS eventType FROM v_ev_sales""")
def _(b):
    return ev.decode(sale_messages(b), model.SALE_EVENT).select(
        "_id", "totalAmount", "companyId", "region", "sector", "saleStatus", "eventType")


def stored_dimension(df: DataFrame, key: str) -> str:
    """The dimension as it is stored, under the key ``_id``; its folder."""
    folder = work_folder(df.sparkSession, "dimension")
    df.withColumnRenamed(key, "_id").write.parquet(folder)
    return folder


@query("src04_products", "SELECT CAST(productId AS STRING) AS productId, productName, brand, productPrice, categoryId FROM v_products")
def _(b): return stored.load_products(b.spark, stored_dimension(b.products, "productId"))


@query("src05_employees", "SELECT CAST(employeeId AS STRING) AS employeeId, employeeName, companyId, position FROM v_employees")
def _(b): return stored.load_employees(b.spark, stored_dimension(b.employees, "employeeId"))


@query("src06_missing_dimension", """
SELECT saleId, productId, brand, CAST(NULL AS STRING) AS productName, quantity FROM v_ev_items""")
def _(b): return j.enrich_items(b.ev_items, None).select("saleId", "productId", "brand", "productName", "quantity")


@query("snk02_merge_additive", """
SELECT companyId, sector, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount,
       six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS avgSaleAmount
FROM v_ev_sales WHERE saleStatus = 'completed' GROUP BY companyId, sector""")
def _(b):
    sums = merge_additive(w.company_windows(b.ev_sales), ["companyId", "sector"], ["revenue", "salesCount"])
    return sums.withColumn("avgSaleAmount", m.ratio(F.col("revenue"), F.col("salesCount")))


@query("snk03_safe_fields", """
SELECT event_id, coalesce(CAST(props ->> '$.k' AS BIGINT), 0) AS k, 0.0::DOUBLE AS missing,
       coalesce(TRY_CAST(event_type AS DOUBLE), 0.0::DOUBLE) AS word, CAST(value AS STRING) AS name FROM events""")
def _(b):
    return b.read("events").select(
        "event_id", m.safe_long(F.get_json_object("props", "$.k")).alias("k"),
        m.safe_double(F.get_json_object("props", "$.missing")).alias("missing"),
        m.safe_double("event_type").alias("word"), m.safe_string("value").alias("name"))


@query("snk05_sale_events", """
SELECT 'sales' AS topic, companyId AS key, CAST(saleId AS STRING) AS id, 'sale.created' AS eventType,
       '2024-06-01T00:00:00.000Z' AS timestamp FROM v_ev_sales
UNION ALL SELECT 'payments', CAST(saleId AS STRING), CAST(saleId AS STRING), 'payment.created', '2024-06-01T00:00:00.000Z'
FROM v_payments
UNION ALL SELECT 'products', CAST(productId AS STRING), CAST(productId AS STRING), 'product.created', '2024-06-01T00:00:00.000Z'
FROM v_products
UNION ALL SELECT 'employees', companyId, CAST(employeeId AS STRING), 'employee.created', '2024-06-01T00:00:00.000Z'
FROM v_employees
UNION ALL SELECT 'clients', companyId, CAST(clientId AS STRING), 'client.created', '2024-06-01T00:00:00.000Z'
FROM v_clients
UNION ALL SELECT 'analytics', sector, sector, 'analytics.updated', '2024-06-01T00:00:00.000Z' FROM t_market""")
def _(b):
    from salesloom.plans import tables as t
    market = t.market_analytics(t.company_analytics(b.sales)).select(
        F.col("sector").alias("companyId"), F.col("sector").alias("_id"))
    parts = [sale_messages(b), ev.to_events(b.payments.withColumn("_id", F.col("saleId")), "payment", AT),
             ev.to_events(b.products.withColumnRenamed("productId", "_id"), "product", AT),
             ev.to_events(b.employees.withColumnRenamed("employeeId", "_id"), "employee", AT),
             ev.to_events(b.clients.withColumnRenamed("clientId", "_id"), "client", AT),
             ev.to_events(market, "analytics", AT)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    body = F.from_json("value", model.ENTITY_EVENT)
    return rows.select("topic", "key", body["_id"].alias("id"), body["eventType"].alias("eventType"),
                       body["timestamp"].alias("timestamp"))


# Filters.
@query("f01_completed", f"SELECT {SALE} FROM v_ev_sales WHERE saleStatus = 'completed'")
def _(b): return sale(f.completed(b.ev_sales))


@query("f02_with_sector", "SELECT saleId, productId, sector FROM v_ev_items WHERE sector IS NOT NULL")
def _(b): return f.with_sector(b.ev_items).select("saleId", "productId", "sector")


@query("f03_with_brand", f"SELECT {LINE}, i.brand FROM v_items i WHERE brand IS NOT NULL AND brand <> ''")
def _(b): return line(f.with_brand(b.items), "brand")


@query("f04_date_range", f"""
SELECT {SALE} FROM v_sales WHERE saleTime >= TIMESTAMP '1996-01-01' AND saleTime <= TIMESTAMP '1996-12-31'""")
def _(b): return sale(f.date_range(b.sales, "saleTime", "1996-01-01", "1996-12-31"))


@query("f05_equal_filters", f"""
SELECT {SALE} FROM v_sales WHERE region = 'ASIA' AND sector = 'BUILDING' AND saleStatus = 'completed'
  AND branchId = 'branch_002' AND saleTime >= TIMESTAMP '1995-01-01'""")
def _(b):
    return sale(f.apply_filters(b.sales, f.Filters(start="1995-01-01", region="ASIA", sector="BUILDING",
                                                  saleStatus="completed", branchId="branch_002")))


@query("f06_filter_products", """
SELECT productId, productName, productPrice, isActive FROM v_products
WHERE productPrice >= 950 AND productPrice <= 1050 AND isActive""")
def _(b):
    return f.filter_products(b.products, 950, 1050, True).select("productId", "productName", "productPrice", "isActive")


@query("f07_peers", f"SELECT {SALE} FROM v_sales WHERE region <> 'ASIA'")
def _(b): return sale(f.peers(b.sales, "region", "ASIA"))


@query("f08_has_employee", "SELECT saleId, employeeId FROM v_sales WHERE employeeId IS NOT NULL")
def _(b): return f.has_employee(b.sales).select("saleId", "employeeId")


@query("f09_last_minutes", f"""
SELECT {SALE} FROM v_ev_sales WHERE saleTime >= (SELECT max(saleTime) FROM v_ev_sales) - INTERVAL 90 MINUTE""")
def _(b): return sale(f.last_minutes(b.ev_sales, 90))


@query("f10_known_keys", "SELECT saleId, companyId, employeeId FROM v_sales WHERE companyId IS NOT NULL AND employeeId IS NOT NULL")
def _(b): return f.known(b.sales, "companyId", "employeeId").select("saleId", "companyId", "employeeId")


@query("f11_lookback", f"""
SELECT {SALE} FROM v_sales WHERE saleTime >= (SELECT max(saleTime) FROM v_sales) - INTERVAL 6 MONTH
  AND saleTime <= (SELECT max(saleTime) FROM v_sales)""")
def _(b): return sale(f.lookback(b.sales, "month"))


# Joins.
@query("j01_enrich_items", f"""
SELECT {LINE}, coalesce(p.brand, i.brand) AS brand, p.productName, p.productPrice
FROM v_items i LEFT JOIN v_products p ON p.productId = i.productId""")
def _(b): return line(j.enrich_items(b.items, b.products), "brand", "productName", "productPrice")


@query("j02_enrich_sales", """
SELECT s.saleId, s.companyId, e.employeeName, e.position FROM v_sales s LEFT JOIN v_employees e ON e.employeeId = s.employeeId""")
def _(b): return j.enrich_sales(b.sales, b.employees).select("saleId", "companyId", "employeeName", "position")


@query("j03_items_with_completed_sale", f"""
SELECT {LINE}, s.companyId FROM v_ev_items i JOIN v_ev_sales s ON s.saleId = i.saleId
WHERE s.saleStatus = 'completed' AND i.sector IS NOT NULL AND i.brand <> ''
  AND i.saleTime BETWEEN s.saleTime - INTERVAL 2 MINUTE AND s.saleTime + INTERVAL 2 MINUTE""")
def _(b): return line(w.join_items_sales(b.ev_items, b.ev_sales), "companyId")


@query("j04_items_with_sale", f"""
SELECT {LINE}, s.companyId, s.sector, s.saleTime FROM v_items i JOIN v_sales s ON s.saleId = i.saleId""")
def _(b): return line(j.items_with_sale(b.items, b.sales, ["companyId", "sector", "saleTime"]),
                      "companyId", "sector", "saleTime")


@query("j05_items_with_product", f"""
SELECT {LINE}, p.productName FROM v_items i JOIN v_products p ON p.productId = i.productId""")
def _(b): return line(j.items_with_product(b.items, b.products, ["productName"]), "productName")


@query("j06_items_with_product_left", f"""
SELECT {LINE}, p.productName FROM v_items i LEFT JOIN v_products p ON p.productId = i.productId""")
def _(b): return line(j.items_with_product(b.items, b.products, ["productName"], "left"), "productName")


@query("j07_items_with_category", f"""
SELECT {LINE}, i.categoryId, c.categoryName FROM v_items i LEFT JOIN v_categories c ON c.categoryId = i.categoryId""")
def _(b): return line(j.items_with_category(b.items, b.categories), "categoryId", "categoryName")


@query("j10_items_of_matching_sales", f"""
SELECT {LINE} FROM v_items i WHERE i.saleId IN (SELECT saleId FROM v_sales WHERE saleStatus = 'completed')""")
def _(b): return line(j.items_of_matching_sales(b.items, f.completed(b.sales)))


@query("j11_populate", """
SELECT p.saleId, CAST(p.paymentAmount AS DOUBLE) AS paymentAmount, s.saleTime, s.saleStatus
FROM v_payments p LEFT JOIN v_sales s ON s.saleId = p.saleId""")
def _(b):
    return j.lookup(b.payments, b.sales, "saleId", ["saleTime", "saleStatus"]).select(
        "saleId", F.col("paymentAmount").cast("double").alias("paymentAmount"), "saleTime", "saleStatus")


@query("j13_sales_with_items", """
SELECT s.saleId, s.companyId, CAST(i.productId AS STRING) AS productId, CAST(i.quantity AS STRING) AS quantity,
       CAST(i.subtotal AS DOUBLE) AS subtotal, p.productName, p.brand AS productBrand
FROM v_sales s LEFT JOIN v_items i ON i.saleId = s.saleId LEFT JOIN v_products p ON p.productId = i.productId""")
def _(b):
    return j.sales_with_items(b.sales, b.items, b.products).select(
        "saleId", "companyId", *text("productId", "quantity"), F.col("subtotal").cast("double").alias("subtotal"),
        "productName", "productBrand")


@query("j14_resolved_employee_names", """
SELECT s.employeeId, coalesce(nullif(trim(CASE WHEN s.employeeId % 3 = 0 THEN ' Stored ' || s.employeeId || ' '
                                         WHEN s.employeeId % 3 = 1 THEN '  ' END), ''), e.employeeName,
         CASE WHEN length(CAST(s.employeeId AS STRING)) >= 4 THEN 'Employee ' || right(CAST(s.employeeId AS STRING), 4)
              ELSE 'Unknown Employee' END) AS employeeName
FROM (SELECT DISTINCT employeeId FROM v_sales WHERE employeeId IS NOT NULL) s
LEFT JOIN v_employees e ON e.employeeId = s.employeeId""")
def _(b):
    ids = f.has_employee(b.sales).select("employeeId").distinct()
    stored = F.when(F.col("employeeId") % 3 == 0, F.concat(F.lit(" Stored "), F.col("employeeId").cast("string"), F.lit(" "))
                    ).when(F.col("employeeId") % 3 == 1, "  ")
    return j.name_employees(ids.withColumn("stored", stored), b.employees, "stored").select("employeeId", "employeeName")


@query("j14_resolved_product_names", """
SELECT i.productId, p.productName, coalesce(p.brand, i.brand) AS brand
FROM (SELECT productId, min(brand) AS brand FROM v_items GROUP BY productId) i
LEFT JOIN v_products p ON p.productId = i.productId""")
def _(b):
    ids = b.items.groupBy("productId").agg(F.min("brand").alias("brand"))
    return j.name_products(ids, b.products).select("productId", "productName", "brand")


@query("rc08_clean_employee_names", """
SELECT c_custkey, CASE WHEN cut IS NULL OR length(cut) < 3 OR regexp_matches(cut, '^[0-9a-fA-F]{4,}$')
                       THEN 'Employee ' || right(CAST(c_custkey AS STRING), 4) ELSE cut END AS employeeName
FROM (SELECT c_custkey, trim(regexp_replace(CASE WHEN contains(split_part(trim(raw), ' - ', 2), 'شركة')
          OR contains(split_part(trim(raw), ' - ', 2), 'Company') THEN trim(split_part(trim(raw), ' - ', 1))
          ELSE trim(raw) END, '\\s*-\\s*(شركة|Company).*$', '', 'i')) AS cut FROM
  (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN c_name || ' - Company X' WHEN 1 THEN c_name || ' - شركة' WHEN 2 THEN '  '
          WHEN 3 THEN 'ab12' WHEN 4 THEN ' ' || c_name WHEN 5 THEN c_name || ' - Acme Company' ELSE NULL END AS raw
   FROM customer))""")
def _(b):
    people = b.read("customer")
    kind, name = F.col("c_custkey") % 7, F.col("c_name")
    raw = (F.when(kind == 0, F.concat(name, F.lit(" - Company X"))).when(kind == 1, F.concat(name, F.lit(" - شركة")))
           .when(kind == 2, "  ").when(kind == 3, "ab12").when(kind == 4, F.concat(F.lit(" "), name))
           .when(kind == 5, F.concat(name, F.lit(" - Acme Company"))))
    return people.select("c_custkey", names.clean_employee_name(raw, F.col("c_custkey")).alias("employeeName"))


# Top-k and listings.
@query("w01_top_per_group", """
SELECT companyId, sector, saleId, CAST(rank AS INT) AS rank, CAST(totalAmount AS DOUBLE) AS totalAmount FROM (
  SELECT *, row_number() OVER (PARTITION BY companyId, sector ORDER BY totalAmount DESC, saleId) AS rank FROM v_sales)
WHERE rank <= 5""")
def _(b):
    return topk.top_per_group(b.sales, ["companyId", "sector"], ["-totalAmount", "saleId"], 5).select(
        "companyId", "sector", "saleId", "rank", F.col("totalAmount").cast("double").alias("totalAmount"))


@query("w02_top_sales", """
SELECT saleId, CAST(totalAmount AS DOUBLE) AS totalAmount FROM v_sales ORDER BY totalAmount DESC, saleId LIMIT 100""")
def _(b): return topk.top(b.sales.select("saleId", F.col("totalAmount").cast("double").alias("totalAmount")),
                          ["-totalAmount", "saleId"], 100)


@query("w04_page_info", """
SELECT count(*) AS total, CAST(ceil(count(*) / 50.0) AS BIGINT) AS totalPages, 2 AS currentPage
FROM v_sales WHERE saleStatus = 'completed'""")
def _(b): return topk.page_info(f.completed(b.sales), 2, 50)


@query("l01_sales_list", """
SELECT s.saleId, s.saleTime, CAST(s.totalAmount AS DOUBLE) AS totalAmount, s.companyId, c.clientName, e.employeeName
FROM (SELECT * FROM v_sales WHERE region = 'ASIA' AND saleTime >= TIMESTAMP '1995-01-01'
      ORDER BY saleTime DESC, saleId LIMIT 50 OFFSET 50) s
LEFT JOIN v_clients c ON c.clientId = s.clientId LEFT JOIN v_employees e ON e.employeeId = s.employeeId""")
def _(b):
    rows = ls.sales_list(b.sales, b.clients, b.employees, f.Filters(region="ASIA", start="1995-01-01"), 2, 50)
    return rows.select("saleId", "saleTime", F.col("totalAmount").cast("double").alias("totalAmount"), "companyId",
                       "clientName", "employeeName")


@query("l02_items_list", """
SELECT i.saleId, i.productId, i.quantity, CAST(i.subtotal AS DOUBLE) AS subtotal, s.saleTime, s.saleStatus,
       p.productName, p.productPrice, c.categoryName
FROM (SELECT * FROM v_items WHERE brand = 'Brand#7' ORDER BY saleId DESC, productId, quantity, subtotal LIMIT 100 OFFSET 100) i
LEFT JOIN v_sales s ON s.saleId = i.saleId LEFT JOIN v_products p ON p.productId = i.productId
LEFT JOIN v_categories c ON c.categoryId = i.categoryId""")
def _(b):
    rows = ls.items_list(b.items, b.sales, b.products, b.categories, 2, 100, brand="Brand#7")
    return line(rows, "saleTime", "saleStatus", "productName", "productPrice", "categoryName")


def last_of(df: DataFrame, order: list[str], n: int) -> dict:
    """The sort columns of the n-th row: what a reader of the pages before has seen last."""
    names = [c.lstrip("-") for c in order]
    row = topk.top(df, order, n).select(*names).offset(n - 1).first()
    return row.asDict() if row else {}


@query("l01_sales_after", """
SELECT s.saleId, s.saleTime, CAST(s.totalAmount AS DOUBLE) AS totalAmount, s.companyId, c.clientName, e.employeeName
FROM (SELECT * FROM v_sales WHERE region = 'ASIA' ORDER BY saleTime DESC, saleId LIMIT 50 OFFSET 150) s
LEFT JOIN v_clients c ON c.clientId = s.clientId LEFT JOIN v_employees e ON e.employeeId = s.employeeId""")
def _(b):
    """The fourth page, asked for by the last row of the third."""
    only = f.Filters(region="ASIA")
    after = last_of(f.apply_filters(b.sales, only), ls.SALES_ORDER, 150)
    rows = ls.sales_list(b.sales, b.clients, b.employees, only, size=50, after=after)
    return rows.select("saleId", "saleTime", F.col("totalAmount").cast("double").alias("totalAmount"), "companyId",
                       "clientName", "employeeName")


@query("l06_payments_after", """
SELECT p.saleId, p.paymentType, p.paymentStatus, p.paymentDate, CAST(p.paymentAmount AS DOUBLE) AS paymentAmount, s.saleTime
FROM (SELECT * FROM v_payments WHERE paymentType = 'card' ORDER BY paymentDate DESC, saleId LIMIT 40 OFFSET 80) p
LEFT JOIN v_sales s ON s.saleId = p.saleId""")
def _(b):
    after = last_of(f.equal_to(b.payments, paymentType="card"), ls.PAYMENTS_ORDER, 80)
    rows = ls.payments_list(b.payments, b.sales, size=40, after=after, paymentType="card")
    return rows.select("saleId", "paymentType", "paymentStatus", "paymentDate",
                       F.col("paymentAmount").cast("double").alias("paymentAmount"), "saleTime")


@query("l03_products_list", """
SELECT p.productId, p.productName, p.productPrice, p.brand, c.categoryName FROM
(SELECT * FROM v_products WHERE isActive AND productPrice >= 950 ORDER BY productId DESC LIMIT 50) p
LEFT JOIN v_categories c ON c.categoryId = p.categoryId""")
def _(b):
    return ls.products_list(b.products, b.categories, is_active=True, min_price=950).select(
        "productId", "productName", "productPrice", "brand", "categoryName")


@query("l04_clients_list", """
SELECT clientId, clientName, region, city, companyId FROM v_clients WHERE region = 'ASIA' ORDER BY clientId DESC LIMIT 50""")
def _(b): return ls.clients_list(b.clients, region="ASIA")


@query("l05_employees_list", """
SELECT employeeId, employeeName, position, companyId, isActive FROM v_employees WHERE isActive ORDER BY employeeId DESC LIMIT 50""")
def _(b): return ls.employees_list(b.employees, isActive=True)


@query("l06_payments_list", """
SELECT p.saleId, CAST(p.paymentAmount AS DOUBLE) AS paymentAmount, p.paymentType, p.paymentStatus, p.paymentDate,
       s.saleStatus, CAST(s.totalAmount AS DOUBLE) AS totalAmount
FROM (SELECT * FROM v_payments WHERE paymentType = 'card' AND paymentDate <= TIMESTAMP '1997-12-31'
      ORDER BY paymentDate DESC, saleId LIMIT 50 OFFSET 50) p LEFT JOIN v_sales s ON s.saleId = p.saleId""")
def _(b):
    rows = ls.payments_list(b.payments, b.sales, end="1997-12-31", number=2, paymentType="card")
    return rows.select("saleId", F.col("paymentAmount").cast("double").alias("paymentAmount"), "paymentType",
                       "paymentStatus", "paymentDate", "saleStatus", F.col("totalAmount").cast("double").alias("totalAmount"))


@query("l07_products_of_brand", "SELECT productId, productName, brand FROM v_products WHERE brand = 'Brand#7' AND isActive")
def _(b): return ls.products_of_brand(b.products, "Brand#7").select("productId", "productName", "brand")


@query("l08_clients_of_region", "SELECT clientId, clientName, region FROM v_clients WHERE region = 'EUROPE'")
def _(b): return ls.clients_of_region(b.clients, "EUROPE").select("clientId", "clientName", "region")


@query("l09_categories_by_name", "SELECT categoryId, categoryName FROM v_categories")
def _(b): return ls.categories_by_name(b.categories)


# Ingestion.
def documents(b: Tables) -> DataFrame:
    """Event sales as nested documents; every seventh has no time, every eleventh line no brand."""
    entry = F.struct(
        "productId", "quantity", F.col("price"), F.lit(None).cast("double").alias("discount"),
        F.lit(None).cast("double").alias("subtotal"),
        F.when(F.col("productId") % 11 != 0, F.col("brand")).alias("brand"),
        F.lit(None).cast("string").alias("categoryId"))
    nested = b.ev_items.groupBy("saleId").agg(F.collect_list(entry).alias("items"))
    heads = b.ev_sales.withColumn("saleTime", F.when(F.col("saleId") % 7 != 0, F.col("saleTime"))).drop("totalAmount")
    return heads.join(nested, "saleId", "left")


@query("i01_split_sales", """
SELECT s.saleId, CASE WHEN s.saleId % 7 = 0 THEN TIMESTAMP '2024-06-01' ELSE s.saleTime END AS saleTime, s.companyId,
       CAST(coalesce(sum(i.subtotal), 0) AS DOUBLE) AS totalAmount
FROM v_ev_sales s LEFT JOIN v_ev_items i ON i.saleId = s.saleId GROUP BY s.saleId, s.saleTime, s.companyId""")
def _(b): return ing.split_sales(documents(b), AT)[0].select("saleId", "saleTime", "companyId", "totalAmount")


@query("i01_split_items", """
SELECT i.saleId, i.productId, i.quantity, CAST(i.subtotal AS DOUBLE) AS subtotal, i.companyId, i.sector,
       CASE WHEN i.saleId % 7 = 0 THEN TIMESTAMP '2024-06-01' ELSE i.saleTime END AS saleTime FROM v_ev_items i""")
def _(b): return line(ing.split_sales(documents(b), AT)[1], "companyId", "sector", "saleTime")


@query("i02_fill_brand", f"""
SELECT {LINE}, coalesce(i.brand, p.brand) AS brand FROM v_items i LEFT JOIN v_products p ON p.productId = i.productId""")
def _(b): return line(ing.fill_brand(b.items, b.products), "brand")


@query("i03_recompute_totals", """
SELECT s.saleId, CAST(coalesce(sum(i.subtotal), 0) AS DOUBLE) AS totalAmount
FROM v_sales s LEFT JOIN v_items i ON i.saleId = s.saleId GROUP BY s.saleId""")
def _(b): return ing.recompute_totals(b.sales, b.items).select("saleId", "totalAmount")


@query("i04_line_subtotal", """
SELECT saleId, productId, CAST(quantity * CAST(price AS DECIMAL(12,4)) -
       CASE WHEN productId % 3 = 0 THEN 0 ELSE 0.5 END AS DOUBLE) AS subtotal FROM v_ev_items""")
def _(b):
    discount = F.when(F.col("productId") % 3 != 0, 0.5)
    return b.ev_items.select("saleId", "productId", ing.line_subtotal(
        F.col("quantity"), F.col("price"), discount).cast("double").alias("subtotal"))


def flawed(b: Tables) -> DataFrame:
    """Documents of which some have an unknown status, a line without quantity or a negative price."""
    worse = F.transform("items", lambda i: i.withField(
        "quantity", F.when(F.col("saleId") % 50 == 0, 0).otherwise(i["quantity"])).withField(
        "price", F.when(F.col("saleId") % 70 == 0, -1.0).otherwise(i["price"])))
    return documents(b).withColumn("items", worse).withColumn(
        "saleStatus", F.when(F.col("saleId") % 30 == 0, "lost").otherwise(F.col("saleStatus")))


FLAWS = """
flaws AS (SELECT s.*, concat_ws(';', CASE WHEN s.saleId % 30 = 0 THEN 'saleStatus is not an allowed value' END,
            CASE WHEN s.saleId % 50 = 0 AND n > 0 THEN 'quantity is less than 1' END,
            CASE WHEN s.saleId % 70 = 0 AND n > 0 THEN 'price is less than 0' END,
            CASE WHEN s.saleId % 70 = 0 AND s.saleId % 50 <> 0 AND n > 0 THEN 'subtotal is less than 0' END) AS errors
          FROM v_ev_sales s LEFT JOIN (SELECT saleId, count(*) AS n FROM v_ev_items GROUP BY saleId) i ON i.saleId = s.saleId)"""


@query("i05_ingest_batch_report", f"""
WITH {FLAWS} SELECT count(*) AS total, count(*) FILTER (WHERE errors = '') AS success,
       count(*) FILTER (WHERE errors <> '') AS failed FROM flaws""")
def _(b):
    report = ing.ingest_batch(flawed(b), source="pos", now=AT).report
    return b.spark.createDataFrame([tuple(report[c] for c in ("total", "success", "failed"))], "total long, success long, failed long")


@query("i05_ingest_batch_errors", f"WITH {FLAWS} SELECT saleId, 'pos' AS source, errors FROM flaws WHERE errors <> ''")
def _(b):
    return ing.ingest_batch(flawed(b), source="pos", now=AT).rejected.select(
        "saleId", "source", F.concat_ws(";", "errors").alias("errors"))


@query("i05_ingest_batch_accepted", f"""
WITH {FLAWS} SELECT f.saleId, 'company_x' AS companyId, f.saleStatus, CAST(coalesce(sum(i.subtotal), 0) AS DOUBLE) AS totalAmount
FROM flaws f LEFT JOIN v_ev_items i ON i.saleId = f.saleId WHERE errors = '' GROUP BY f.saleId, f.saleStatus""")
def _(b):
    return ing.ingest_batch(flawed(b), company_id="company_x", now=AT).accepted.select(
        "saleId", "companyId", "saleStatus", "totalAmount")


@query("i05_documents_to_messages", f"""
WITH {FLAWS},
good AS (SELECT f.saleId, f.companyId, CAST(coalesce(sum(i.subtotal), 0) AS DOUBLE) AS totalAmount, count(i.saleId) AS n
         FROM flaws f LEFT JOIN v_ev_items i ON i.saleId = f.saleId WHERE errors = '' GROUP BY f.saleId, f.companyId)
SELECT 'sales' AS topic, companyId AS key, CAST(saleId AS STRING) AS id, totalAmount AS amount, n AS lines FROM good
UNION ALL SELECT 'sale_items', CAST(g.saleId AS STRING), CAST(g.saleId AS STRING), CAST(sum(i.subtotal) AS DOUBLE), count(*)
FROM good g JOIN v_ev_items i ON i.saleId = g.saleId GROUP BY g.saleId""")
def _(b):
    """The whole flow: documents are checked, split and sent; the messages are read back from where they were sent."""
    folder = work_folder(b.spark, "messages")
    ing.ingest_sales(flawed(b), b.products, {"path": folder}, now=AT, at=AT)
    sent = b.spark.read.parquet(folder).select("topic", "key", F.from_json(
        "value", "_id string, saleId string, totalAmount double, subtotal double, items array<struct<productId long>>").alias("v"))
    sales = sent.filter("topic = 'sales'").select(
        "topic", "key", F.col("v._id").alias("id"), F.col("v.totalAmount").alias("amount"),
        F.size(F.coalesce("v.items", F.array())).cast("bigint").alias("lines"))
    items = sent.filter("topic = 'sale_items'").groupBy("topic", "key", F.col("v.saleId").alias("id")).agg(
        m.total("v.subtotal").alias("amount"), F.count("*").alias("lines"))
    return sales.unionByName(items)


@query("i06_validate_sales", """
SELECT event_id, coalesce(CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END, 'completed') AS saleStatus,
       concat_ws(';', CASE WHEN event_id % 9 <> 0 AND event_type NOT IN ('pending', 'completed', 'cancelled') THEN 'saleStatus is not an allowed value' END,
                 CASE WHEN value - 50 < 0 THEN 'totalAmount is less than 0' END) AS errors FROM events""")
def _(b):
    rows = b.read("events").select(
        "event_id", (F.col("value") - 50).alias("totalAmount"),
        F.when(F.col("event_id") % 9 != 0, F.col("event_type")).alias("saleStatus"))
    return v.validate(rows, "sales").select("event_id", "saleStatus", F.concat_ws(";", "errors").alias("errors"))


@query("i06_validate_people", """
SELECT c_custkey, trim(raw) AS employeeName, lower(trim(mail)) AS employeeEmail, true AS isActive,
       concat_ws(';', CASE WHEN trim(raw) = '' THEN 'employeeName is required' END,
                 CASE WHEN mail IS NULL THEN 'employeeEmail is required' END, 'employeePhone is required') AS errors
FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE ' ' || c_name END AS raw,
             CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_name || '@X.COM ' END AS mail FROM customer)""")
def _(b):
    rows = b.read("customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_name")).alias("employeeName"),
        F.when(F.col("c_custkey") % 15 != 0, F.concat("c_name", F.lit("@X.COM "))).alias("employeeEmail"))
    return v.validate(rows, "employees").select(
        "c_custkey", "employeeName", "employeeEmail", "isActive", F.concat_ws(";", "errors").alias("errors"))


def faults(*pairs: str) -> str:
    """Reasons of a row, joined, from pairs of a condition and its text."""
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {when} THEN '{text}' END" for when, text in zip(pairs[::2], pairs[1::2])) + ")"


@query("i06_validate_items", f"""
SELECT l_orderkey, l_linenumber, coalesce(trim(note), '') AS itemNotes, 0 AS discount, {faults(
    "l_orderkey % 11 = 0", "productId is required", "l_linenumber = 2", "quantity is less than 1", "l_linenumber = 3",
    "price is required", "l_linenumber = 4", "price is less than 0", "l_orderkey % 13 = 0", "subtotal is required")} AS errors
FROM (SELECT *, '  ' || l_returnflag || ' ' AS note FROM lineitem)""")
def _(b):
    order, number = F.col("l_orderkey"), F.col("l_linenumber")
    rows = b.read("lineitem").select(
        "l_orderkey", "l_linenumber", order.alias("saleId"), F.when(order % 11 != 0, F.col("l_partkey")).alias("productId"),
        F.when(number == 2, 0).otherwise(1).alias("quantity"),
        F.when(number == 4, -1.0).when(number != 3, 2.0).alias("price"), F.when(order % 13 != 0, 2.0).alias("subtotal"),
        F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("itemNotes"))
    return v.validate(rows, "sale_items").select(
        "l_orderkey", "l_linenumber", "itemNotes", "discount", F.concat_ws(";", "errors").alias("errors"))


@query("i06_validate_products", f"""
SELECT p_partkey, 'piece' AS unit, 0 AS stockQuantity, true AS isActive, trim(name) AS productName, {faults(
    "trim(name) = ''", "productName is required", "length(trim(name)) > 100", "productName is longer than 100",
    "p_partkey % 8 = 0", "productPrice is required", "p_partkey % 8 = 1", "productPrice is less than 0")} AS errors
FROM (SELECT *, CASE p_partkey % 6 WHEN 0 THEN '   ' WHEN 1 THEN repeat(p_name, 20) ELSE p_name || ' ' END AS name FROM part)""")
def _(b):
    key = F.col("p_partkey")
    name = F.when(key % 6 == 0, "   ").when(key % 6 == 1, F.repeat("p_name", F.lit(20))).otherwise(F.concat("p_name", F.lit(" ")))
    rows = b.read("part").select("p_partkey", name.alias("productName"),
                                 F.when(key % 8 == 1, -5.0).when(key % 8 != 0, 5.0).alias("productPrice"))
    return v.validate(rows, "products").select("p_partkey", "unit", "stockQuantity", "isActive", "productName",
                                               F.concat_ws(";", "errors").alias("errors"))


@query("i06_validate_clients", f"""
SELECT c_custkey, lower(c_name) || '@x.com' AS clientEmail, trim(place) AS clientLocation, {faults(
    "trim(place) = ''", "clientLocation is required")} AS errors
FROM (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE ' Street ' || c_custkey END AS place FROM customer)""")
def _(b):
    key = F.col("c_custkey")
    rows = b.read("customer").select(
        "c_custkey", F.col("c_name").alias("clientName"), F.concat(F.lit(" "), "c_name", F.lit("@X.com ")).alias("clientEmail"),
        key.cast("string").alias("clientPhone"),
        F.when(key % 7 == 0, " ").otherwise(F.concat(F.lit(" Street "), key.cast("string"))).alias("clientLocation"))
    return v.validate(rows, "clients").select("c_custkey", "clientEmail", "clientLocation",
                                              F.concat_ws(";", "errors").alias("errors"))


@query("i06_validate_payments", f"""
SELECT o_orderkey, coalesce(CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'lost' ELSE 'failed' END, 'pending') AS paymentStatus, {faults(
    "o_orderkey % 9 = 0", "paymentAmount is required", "o_orderkey % 9 = 1", "paymentAmount is less than 0",
    "o_orderkey % 5 = 0", "paymentType is required", "o_orderkey % 5 = 1", "paymentType is not an allowed value",
    "o_orderkey % 4 = 1", "paymentStatus is not an allowed value")} AS errors FROM orders""")
def _(b):
    key = F.col("o_orderkey")
    rows = b.read("orders").select(
        "o_orderkey", key.alias("saleId"), F.when(key % 9 == 1, -1.0).when(key % 9 != 0, 1.0).alias("paymentAmount"),
        F.when(key % 5 == 1, "barter").when(key % 5 != 0, "card").alias("paymentType"),
        F.when(key % 4 == 1, "lost").when(key % 4 != 0, "failed").alias("paymentStatus"))
    return v.validate(rows, "payments").select("o_orderkey", "paymentStatus", F.concat_ws(";", "errors").alias("errors"))


@query("i06_validate_categories", f"""
SELECT p_partkey, trim(name) AS categoryName, {faults(
    "trim(name) = ''", "categoryName is required", "length(trim(name)) < 2", "categoryName is shorter than 2",
    "length(trim(name)) > 50", "categoryName is longer than 50", "p_partkey % 5 = 0", "categoryDescription is longer than 200")} AS errors
FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN ' x ' WHEN 2 THEN repeat(p_type, 20) ELSE p_type END AS name FROM part)""")
def _(b):
    key = F.col("p_partkey")
    name = F.when(key % 4 == 0, " ").when(key % 4 == 1, " x ").when(key % 4 == 2, F.repeat("p_type", F.lit(20))).otherwise(F.col("p_type"))
    rows = b.read("part").select("p_partkey", name.alias("categoryName"),
                                 F.when(key % 5 == 0, F.repeat(F.lit("long "), F.lit(60))).otherwise("short").alias("categoryDescription"))
    return v.validate(rows, "categories").select("p_partkey", "categoryName", F.concat_ws(";", "errors").alias("errors"))


def product_changes(b: Tables) -> tuple[DataFrame, DataFrame]:
    """Two changes per part: the price, then the brand. A third has only a barcode, every 17th no key."""
    base = b.products.select("productId", "productName", "productPrice", "brand", "sku", F.when(
        F.col("productId") % 2 == 0, F.concat(F.lit("BC"), F.col("productId").cast("string"))).alias("barcode"))
    key, keyed = F.col("key"), F.col("key") % 17 != 0
    part = b.read("part").select(unknown(F.col("p_partkey"), 40).alias("key"), "p_retailprice", F.explode(F.array(F.lit(0), F.lit(1))).alias("step"))
    return base, part.select(
        (key * 2 + F.col("step")).alias("seq"),
        F.when(keyed & (key % 3 != 0), F.concat(F.lit("SKU"), key.cast("string"))).alias("sku"),
        F.when(keyed & (key % 3 == 0), F.concat(F.lit("BC"), key.cast("string"))).alias("barcode"),
        F.when(F.col("step") == 0, F.col("p_retailprice") + 1).alias("productPrice"),
        F.when(F.col("step") == 1, "Brand#New").alias("brand"))


@query("i07_merge_products", """
WITH base AS (SELECT productId, productName, productPrice, brand, sku,
                     CASE WHEN productId % 2 = 0 THEN 'BC' || productId END AS barcode FROM v_products),
parts AS (SELECT CASE WHEN p_partkey % 40 = 0 THEN -p_partkey ELSE p_partkey END AS k, p_retailprice + 1 AS price,
                 p_partkey % 40 <> 0 AS stored FROM part),
hit AS (SELECT k, price FROM parts WHERE stored AND k % 17 <> 0 AND (k % 3 <> 0 OR k % 2 = 0))
SELECT CAST(b.productId AS STRING) AS productId, b.productName, coalesce(h.price, b.productPrice) AS productPrice,
       CASE WHEN h.k IS NULL THEN b.brand ELSE 'Brand#New' END AS brand, b.sku, b.barcode,
       CASE WHEN h.k IS NULL THEN 'unchanged' ELSE 'updated' END AS action
FROM base b LEFT JOIN hit h ON h.k = b.productId
UNION ALL
SELECT substr(md5(CASE WHEN k % 3 <> 0 THEN 'sku:SKU' || k ELSE 'barcode:BC' || k END), 1, 24), NULL, price, 'Brand#New',
       CASE WHEN k % 3 <> 0 THEN 'SKU' || k END, CASE WHEN k % 3 = 0 THEN 'BC' || k END, 'created'
FROM parts WHERE k % 17 <> 0 AND k NOT IN (SELECT k FROM hit)
UNION ALL
SELECT substr(md5('row:' || (2 * k)), 1, 24), NULL, price, NULL, NULL, NULL, 'created' FROM parts WHERE k % 17 = 0
UNION ALL
SELECT substr(md5('row:' || (2 * k + 1)), 1, 24), NULL, NULL, 'Brand#New', NULL, NULL, 'created' FROM parts WHERE k % 17 = 0""")
def _(b):
    base, changes = product_changes(b)
    return merge_keyed(base, changes, "productId", ["sku", "barcode"])


@query("i07_merge_in_order", """
WITH p AS (SELECT p_partkey AS k, p_partkey % 3 AS kind FROM part)
SELECT 'old' || k AS id, 'old' || k AS sku, 'N' || k AS barcode, 1::BIGINT AS price, 'updated' AS action FROM p WHERE kind = 1
UNION ALL SELECT 'old' || k, 'old' || k, 'B' || k, 3, 'updated' FROM p WHERE kind = 2
UNION ALL SELECT substr(md5('barcode:B' || k), 1, 24), NULL, 'B' || k, 3, 'created' FROM p WHERE kind < 2
UNION ALL SELECT substr(md5('sku:S' || k), 1, 24), 'S' || k, 'B' || k, 2, 'created' FROM p WHERE kind = 0""")
def _(b):
    """Three changes of each part's barcode, by its number modulo 3.

    0: asked for before a new sku takes it (two rows, and the first keeps the barcode's later changes). 1: the stored
    row moves on to another barcode, so that the next change makes a row. 2: always the stored row.
    """
    key, kind, step = F.col("p_partkey"), F.col("p_partkey") % 3, F.col("step")
    text = lambda prefix: F.concat(F.lit(prefix), key.cast("string"))
    part = b.read("part").select("p_partkey")
    base = part.filter(kind > 0).select(text("old").alias("id"), text("old").alias("sku"), text("B").alias("barcode"),
                                        F.lit(0).cast("bigint").alias("price"))
    rows = part.withColumn("step", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    changes = rows.select(
        (key * 3 + step).alias("seq"),
        F.when((kind == 0) & (step == 2), text("S")).when((kind == 1) & (step == 2), text("old")).alias("sku"),
        F.when((kind == 1) & (step == 2), text("N")).otherwise(text("B")).alias("barcode"),
        F.when((kind != 1) | (step != 2), step.cast("bigint")).alias("price"))
    return merge_keyed(base, changes, "id", ["sku", "barcode"])


@query("i08_merge_clients", """
WITH c AS (SELECT c_custkey AS k, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT CAST(k AS STRING) AS clientId, CASE WHEN k % 4 = 0 THEN 'Renamed ' || k ELSE c_name END AS clientName,
       c_name || '@x.com' AS clientEmail, 'T' || k AS clientPhone,
       CASE WHEN k % 4 = 1 THEN 'Moved' ELSE n_name END AS city,
       CASE WHEN k % 4 < 2 THEN 'updated' ELSE 'unchanged' END AS action FROM c
UNION ALL
SELECT substr(md5('clientEmail:new' || k || '@x.com'), 1, 24), 'New ' || k, 'new' || k || '@x.com', NULL, NULL, 'created'
FROM c WHERE k % 4 = 2""")
def _(b):
    """By email, else by phone."""
    key = F.col("clientId")
    base = b.clients.select("clientId", "clientName", F.concat("clientName", F.lit("@x.com")).alias("clientEmail"),
                            F.concat(F.lit("T"), key.cast("string")).alias("clientPhone"), "city")
    named = lambda prefix: F.concat(F.lit(prefix), key.cast("string"))
    changes = b.clients.filter(key % 4 < 3).select(
        key.alias("seq"),
        F.when(key % 4 == 0, F.concat("clientName", F.lit("@x.com")))
        .when(key % 4 == 2, F.concat(named("new"), F.lit("@x.com"))).alias("clientEmail"),
        F.when(key % 4 == 1, named("T")).alias("clientPhone"),
        F.when(key % 4 == 0, named("Renamed ")).when(key % 4 == 2, named("New ")).alias("clientName"),
        F.when(key % 4 == 1, "Moved").alias("city"))
    return merge_keyed(base, changes, "clientId", ["clientEmail", "clientPhone"])


@query("i09_merge_employees", """
SELECT CAST(employeeId AS STRING) AS employeeId, employeeName, employeeName || '@x.com' AS employeeEmail,
       CASE WHEN employeeId % 2 = 0 AND employeeId % 30 <> 0 THEN 'Manager' ELSE position END AS position,
       CASE WHEN employeeId % 2 = 0 AND employeeId % 30 <> 0 THEN 'updated' ELSE 'unchanged' END AS action FROM v_employees
UNION ALL
SELECT substr(md5('employeeEmail:' || c_name || '@new.com'), 1, 24), NULL, c_name || '@new.com', 'Manager', 'created'
FROM customer WHERE c_custkey % 30 = 0""")
def _(b):
    """By email. Each change comes three times, the last one counts; every 15th of them is of a new employee."""
    base = b.employees.select("employeeId", "employeeName", F.concat("employeeName", F.lit("@x.com")).alias("employeeEmail"),
                              "position")
    step = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("step")
    rows = b.read("customer").filter(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_name", step)
    changes = rows.select((F.col("c_custkey") * 3 + F.col("step")).alias("seq"),
                          F.concat("c_name", F.when(F.col("c_custkey") % 30 == 0, "@new.com").otherwise("@x.com"))
                          .alias("employeeEmail"),
                          F.when(F.col("step") == 2, "Manager").otherwise("Clerk").alias("position"))
    return merge_keyed(base, changes, "employeeId", ["employeeEmail"])


@query("i10_ingest_payments", """
SELECT CASE WHEN saleId % 25 = 0 THEN 'none' ELSE CAST(saleId AS STRING) END AS saleId, paymentType, paymentStatus,
       CASE WHEN saleId % 25 = 0 THEN 'saleId is required' ELSE '' END AS errors FROM v_payments""")
def _(b):
    rows = b.payments.withColumn("saleId", F.when(F.col("saleId") % 25 != 0, F.col("saleId")))
    good, bad = ing.ingest_payments(rows, AT)
    both = good.withColumn("errors", F.array().cast("array<string>")).unionByName(bad)
    return both.select(F.coalesce(F.col("saleId").cast("string"), F.lit("none")).alias("saleId"), "paymentType",
                       "paymentStatus", F.concat_ws(";", "errors").alias("errors"))


@query("i11_orphan_items", f"""
SELECT {LINE} FROM v_items i WHERE NOT EXISTS (SELECT 1 FROM v_products p WHERE p.productId = i.productId)""")
def _(b): return line(j.orphans(b.items, b.products, "productId"))


@query("i11_orphan_payments", """
SELECT p.saleId, CAST(p.paymentAmount AS DOUBLE) AS paymentAmount FROM v_payments p
WHERE NOT EXISTS (SELECT 1 FROM v_items i WHERE i.saleId = p.saleId)""")
def _(b):
    """Payments of sales without any line."""
    return j.orphans(b.payments, b.items, "saleId").select(
        "saleId", F.col("paymentAmount").cast("double").alias("paymentAmount"))
