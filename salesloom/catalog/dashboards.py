"""Dashboard, real-time and result-table questions."""

from __future__ import annotations

from salesloom.catalog.registry import query
from salesloom.operators.filters import Filters
from salesloom.plans import dashboard as d
from salesloom.plans import realtime as r
from salesloom.plans import tables as t

KPI = ("six(CAST(sum(totalAmount) AS DOUBLE)) AS totalRevenue, count(*) AS totalSales, "
       "six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS avgSaleAmount")
YEAR = Filters(start="1996-01-01", end="1996-12-31")
COMPANY, SECTOR = "NATION_3", "BUILDING"


@query("a01_sales_summary", """
SELECT six(CAST(sum(totalAmount) AS DOUBLE)) AS totalRevenue, count(*) AS totalSales,
       six(CAST(sum(totalAmount) AS DOUBLE) / count(*)) AS averageSaleAmount FROM v_sales""")
def _(b): return d.sales_summary(b.sales)


@query("a02_sales_by_status", """
SELECT saleStatus, count(*) AS count, CAST(sum(totalAmount) AS DOUBLE) AS revenue FROM v_sales GROUP BY saleStatus""")
def _(b): return d.sales_by_status(b.sales)


@query("a03_sales_by_type", """
SELECT saleType, count(*) AS count, CAST(sum(totalAmount) AS DOUBLE) AS revenue FROM v_sales GROUP BY saleType""")
def _(b): return d.sales_by_type(b.sales)


@query("a04_summary_from_tables", f"""
SELECT CAST(coalesce(sum(CAST(revenue AS DECIMAL(28,4))), 0) AS DOUBLE) AS totalRevenue,
       CAST(coalesce(sum(salesCount), 0) AS BIGINT) AS totalSales,
       coalesce(six(CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) / sum(salesCount)), 0) AS averageSaleAmount FROM t_company WHERE companyId = '{COMPANY}'""")
def _(b):
    company = t.company_analytics(b.sales)
    return d.summary_from_tables(company, t.market_analytics(company), Filters(companyId=COMPANY))


@query("a05_sales_by_region", f"SELECT region, {KPI} FROM v_sales GROUP BY region")
def _(b): return d.sales_by_region(b.sales)


@query("a06_sales_by_company",
       f"SELECT companyId, {KPI}, count(DISTINCT branchId) AS branchCount FROM v_sales GROUP BY companyId")
def _(b): return d.sales_by_company(b.sales)


@query("a07_sector_companies_table", """
SELECT companyId, sector, revenue AS totalRevenue, salesCount AS totalSales, six(avgSaleAmount) AS avgSaleAmount
FROM t_company""")
def _(b): return d.sector_companies_table(t.company_analytics(b.sales))


@query("a08_sales_trends", f"""
SELECT strftime(saleTime, '%Y-%m-%d') AS bucket, {KPI} FROM v_sales GROUP BY 1""")
def _(b): return d.sales_trends(b.sales, "day")


@query("a08_sales_trends_week", f"SELECT strftime(saleTime, '%Y-W%V') AS bucket, {KPI} FROM v_sales GROUP BY 1")
def _(b): return d.sales_trends(b.sales, "week")


@query("a08_sales_trends_month", f"SELECT strftime(saleTime, '%Y-%m') AS bucket, {KPI} FROM v_sales GROUP BY 1")
def _(b): return d.sales_trends(b.sales, "month")


@query("a08_sales_trends_hour", f"SELECT strftime(saleTime, '%Y-%m-%d %H:00') AS bucket, {KPI} FROM v_ev_sales GROUP BY 1")
def _(b): return d.sales_trends(b.ev_sales, "hour")


@query("a09_top_products", """
SELECT i.productId, p.productName, p.brand, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       CAST(sum(subtotal) AS DOUBLE) AS totalRevenue, count(*) AS totalSales, six(avg(price)) AS avgPrice
FROM v_items i JOIN v_sales s ON s.saleId = i.saleId JOIN v_products p ON p.productId = i.productId
GROUP BY i.productId, p.productName, p.brand ORDER BY totalQuantity DESC, productId LIMIT 10""")
def _(b): return d.top_products(b.items, b.sales, b.products)


@query("a10_top_products_table_market", """
SELECT sector, productId, coalesce(productName, 'Unknown') AS productName, brand, totalRevenue, totalQuantity,
       six(avgPrice) AS avgPrice
FROM t_market_products
QUALIFY row_number() OVER (PARTITION BY sector ORDER BY totalRevenue DESC, productId) <= 50""")
def _(b):
    return d.top_products_table(t.market_top_products(t.company_top_products(b.placed_items, b.products)), 50)


@query("a10_top_products_table_company", f"""
SELECT companyId, sector, productId, coalesce(productName, 'Unknown') AS productName, brand, totalRevenue, totalQuantity,
       six(avgPrice) AS avgPrice
FROM t_company_products WHERE companyId = '{COMPANY}' ORDER BY totalRevenue DESC, sector, productId LIMIT 15""")
def _(b):
    return d.top_products_table(t.company_top_products(b.placed_items, b.products), 15, companyId=COMPANY)


@query("a11_company_top_products", f"""
SELECT i.productId, p.productName, p.brand, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       CAST(sum(subtotal) AS DOUBLE) AS totalRevenue, count(*) AS totalSales
FROM v_items i LEFT JOIN v_products p ON p.productId = i.productId
WHERE i.saleId IN (SELECT saleId FROM v_sales WHERE companyId = '{COMPANY}')
GROUP BY i.productId, p.productName, p.brand ORDER BY totalRevenue DESC, productId LIMIT 15""")
def _(b): return d.company_top_products_batch(b.items, b.sales, b.products, COMPANY)


@query("a12_products_by_brand", """
SELECT i.brand, CAST(sum(quantity) AS BIGINT) AS totalQuantity, CAST(sum(subtotal) AS DOUBLE) AS totalRevenue,
       count(*) AS totalSales, six(avg(price)) AS avgPrice
FROM v_items i JOIN v_sales s ON s.saleId = i.saleId GROUP BY i.brand""")
def _(b): return d.products_by_brand(b.items, b.sales)


@query("a13_brands_table_company", """
SELECT companyId, sector, brand, revenue, quantity, six(avgPrice) AS avgPrice, CAST(rank AS INT) AS rank FROM t_brands""")
def _(b):
    return d.brands_table(t.company_brands(t.company_brands_all(t.branded_items(b.placed_items, b.sales, b.products))))


@query("a13_brands_table_market", f"""
SELECT sector, brand, six(totalRevenue) AS totalRevenue, maxQuantity FROM t_market_brands WHERE sector = '{SECTOR}'""")
def _(b):
    brands = t.company_brands_all(t.branded_items(b.placed_items, b.sales, b.products))
    return d.brands_table(t.market_top_brands(brands), sector=SECTOR)


@query("a14_products_by_category", """
SELECT i.categoryId, c.categoryName, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       CAST(sum(subtotal) AS DOUBLE) AS totalRevenue, count(*) AS totalSales
FROM v_items i JOIN v_sales s ON s.saleId = i.saleId LEFT JOIN v_categories c ON c.categoryId = i.categoryId
GROUP BY i.categoryId, c.categoryName""")
def _(b): return d.products_by_category(b.items, b.sales, b.categories)


@query("a15_employee_performance", f"""
SELECT a.employeeId, totalRevenue, totalSales, avgSaleAmount, maxSaleAmount,
       coalesce(e.employeeName, 'Unknown') AS employeeName, coalesce(e.position, 'N/A') AS position
FROM (SELECT employeeId, {KPI}, CAST(max(totalAmount) AS DOUBLE) AS maxSaleAmount
      FROM v_sales WHERE employeeId IS NOT NULL GROUP BY employeeId) a
LEFT JOIN v_employees e ON e.employeeId = a.employeeId ORDER BY totalRevenue DESC, a.employeeId LIMIT 120""")
def _(b): return d.employee_performance(b.sales, b.employees, k=120)


@query("a15_employee_performance_company", f"""
SELECT a.employeeId, totalRevenue, totalSales, avgSaleAmount, maxSaleAmount, e.employeeName, e.position
FROM (SELECT employeeId, {KPI}, CAST(max(totalAmount) AS DOUBLE) AS maxSaleAmount
      FROM v_sales WHERE employeeId IS NOT NULL AND companyId = '{COMPANY}' GROUP BY employeeId) a
JOIN v_employees e ON e.employeeId = a.employeeId AND e.companyId = '{COMPANY}'
ORDER BY totalRevenue DESC, a.employeeId LIMIT 10""")
def _(b): return d.employee_performance(b.sales, b.employees, Filters(companyId=COMPANY))


@query("a16_company_employee_performance", f"""
SELECT s.companyId, s.employeeId, {KPI}, e.employeeName, e.position
FROM v_sales s JOIN v_employees e ON e.employeeId = s.employeeId AND e.companyId = s.companyId
GROUP BY s.companyId, s.employeeId, e.employeeName, e.position
QUALIFY row_number() OVER (PARTITION BY s.companyId ORDER BY totalRevenue DESC, s.employeeId) <= 50""")
def _(b): return d.company_employee_performance(b.sales, b.employees)


@query("a17_employees_table", f"""
SELECT companyId, employeeId, employeeName, 'N/A' AS position, revenue AS totalRevenue, salesCount AS totalSales,
       six(avgSaleAmount) AS avgSaleAmount, six(avgSaleAmount) AS maxSaleAmount
FROM t_employees ORDER BY revenue DESC, companyId, employeeId LIMIT 120""")
def _(b): return d.employees_table(t.company_employees(b.sales, b.employees), k=120)


DASHBOARD_SQL = """
SELECT 'summary' AS section, NULL AS key, CAST(sum(totalAmount) AS DOUBLE) AS totalRevenue, CAST(count(*) AS DOUBLE) AS totalSales,
       CAST(NULL AS DOUBLE) AS totalQuantity FROM v_sales
UNION ALL (SELECT 'salesByRegion', region, CAST(sum(totalAmount) AS DOUBLE) AS rev, count(*), NULL
           FROM v_sales GROUP BY region ORDER BY rev DESC, region LIMIT 10)
UNION ALL (SELECT 'salesByCompany', companyId, CAST(sum(totalAmount) AS DOUBLE) AS rev, count(*), NULL
           FROM v_sales GROUP BY companyId ORDER BY rev DESC, companyId LIMIT 10)
UNION ALL (SELECT 'topProducts', CAST(i.productId AS STRING), CAST(sum(subtotal) AS DOUBLE), count(*),
                  CAST(sum(quantity) AS DOUBLE) AS q
           FROM v_items i JOIN v_sales s ON s.saleId = i.saleId JOIN v_products p ON p.productId = i.productId
           GROUP BY i.productId ORDER BY q DESC, i.productId LIMIT 10)
UNION ALL (SELECT 'employeePerformance', CAST(employeeId AS STRING), CAST(sum(totalAmount) AS DOUBLE) AS rev, count(*), NULL
           FROM v_sales WHERE employeeId IS NOT NULL GROUP BY employeeId ORDER BY rev DESC, employeeId LIMIT 10)"""


@query("a18_dashboard", DASHBOARD_SQL)
def _(b): return d.dashboard_table(b.sales, b.items, b.products, b.employees)


@query("a19_company_overview", f"""
SELECT 'summary' AS section, NULL AS key, coalesce(sum(revenue), 0) AS totalRevenue,
       CAST(coalesce(sum(salesCount), 0) AS DOUBLE) AS totalSales, CAST(NULL AS DOUBLE) AS totalQuantity FROM t_company WHERE companyId = '{COMPANY}' AND sector = '{SECTOR}'
UNION ALL SELECT 'sectorRegions', region, revenue, salesCount, NULL FROM t_region WHERE sector = '{SECTOR}'""")
def _(b):
    company = t.company_analytics(b.sales)
    return d.company_overview(company, t.market_analytics(company), t.sales_by_region(b.sales), COMPANY, SECTOR)


@query("a20_sector_overview", f"""
SELECT 'summary' AS section, NULL AS key, marketRevenue AS totalRevenue, CAST(marketSalesCount AS DOUBLE) AS totalSales,
       CAST(NULL AS DOUBLE) AS totalQuantity FROM t_market WHERE sector = '{SECTOR}'
UNION ALL SELECT 'totalCompanies', NULL, NULL, totalCompanies, NULL FROM t_market WHERE sector = '{SECTOR}'
UNION ALL SELECT 'salesByRegion', region, revenue, salesCount, NULL FROM t_region WHERE sector = '{SECTOR}'
UNION ALL (SELECT 'topProducts', CAST(productId AS STRING), totalRevenue, NULL, totalQuantity
           FROM t_market_products WHERE sector = '{SECTOR}' ORDER BY totalRevenue DESC, productId LIMIT 50)""")
def _(b):
    return d.sector_overview(
        t.market_analytics(t.company_analytics(b.sales)), t.sales_by_region(b.sales),
        t.market_top_products(t.company_top_products(b.placed_items, b.products)), SECTOR)


@query("a21_sector_companies", f"SELECT sector, companyId, {KPI} FROM v_sales GROUP BY sector, companyId")
def _(b): return d.sector_companies(b.sales)


@query("a22_sector_regions", f"SELECT sector, region, {KPI} FROM v_sales GROUP BY sector, region")
def _(b): return d.sector_regions(b.sales)


@query("a23_company_in_sector", f"""
SELECT coalesce(totalRevenue, 0) AS totalRevenue, totalSales, coalesce(avgSaleAmount, 0) AS avgSaleAmount
FROM (SELECT {KPI} FROM v_sales WHERE companyId = '{COMPANY}' AND sector = '{SECTOR}')""")
def _(b): return d.company_in_sector(b.sales, COMPANY, SECTOR)


@query("a24_combined_market", """
SELECT 'topProducts' AS section, key, totalRevenue, CAST(NULL AS DOUBLE) AS totalSales, totalQuantity FROM (
  SELECT CAST(productId AS STRING) AS key, CAST(sum(CAST(totalRevenue AS DECIMAL(28,4))) AS DOUBLE) AS totalRevenue, CAST(sum(totalQuantity) AS DOUBLE) AS totalQuantity
  FROM t_market_products WHERE sector IN ('BUILDING', 'MACHINERY') GROUP BY productId ORDER BY sum(totalQuantity) DESC, productId LIMIT 20)
UNION ALL SELECT 'salesByRegion', region, CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE), CAST(sum(salesCount) AS DOUBLE), NULL FROM t_region
  WHERE sector IN ('BUILDING', 'MACHINERY') GROUP BY region
UNION ALL SELECT 'summary', NULL, CAST(sum(CAST(marketRevenue AS DECIMAL(28,4))) AS DOUBLE), CAST(sum(totalCompanies) AS DOUBLE), NULL FROM t_market
  WHERE sector IN ('BUILDING', 'MACHINERY')""")
def _(b):
    return d.combined_market(
        t.market_analytics(t.company_analytics(b.sales)), t.sales_by_region(b.sales),
        t.market_top_products(t.company_top_products(b.placed_items, b.products)), ["BUILDING", "MACHINERY"])


@query("a25_region_share", """
SELECT region, CAST(sum(salesCount) AS BIGINT) AS totalSales, round(sum(revenue)) AS revenue,
       round(sum(salesCount) * 100.0 / (SELECT sum(salesCount) FROM t_region), 1)::DOUBLE AS percentage
FROM t_region GROUP BY region""")
def _(b): return d.region_share(t.sales_by_region(b.sales))


# Result tables by batch.
@query("ru1_sales_by_sector", """
SELECT sector, marketRevenue AS revenue, marketSalesCount AS salesCount, six(marketAvgSale) AS avgSaleAmount
FROM t_market""")
def _(b): return t.sales_by_sector(t.market_analytics(t.company_analytics(b.sales)))


@query("ru2_sales_by_region", "SELECT * FROM t_region")
def _(b): return t.sales_by_region(b.sales)


@query("ru3_market_top_products", """
SELECT sector, productId, productName, brand, totalRevenue, totalQuantity, six(avgPrice) AS avgPrice
FROM t_market_products""")
def _(b): return t.market_top_products(t.company_top_products(b.placed_items, b.products))


@query("ru4_company_top_products", """
SELECT companyId, sector, productId, productName, brand, totalRevenue, totalQuantity, six(avgPrice) AS avgPrice
FROM t_company_products""")
def _(b): return t.company_top_products(b.placed_items, b.products)


@query("ru5_market_top_brands", "SELECT * FROM t_market_brands")
def _(b):
    branded = t.branded_items(b.placed_items, b.sales, b.products)
    return t.market_top_brands(t.company_brands_all(branded), branded)


@query("ru6_market_employee_performance", """
SELECT sector, six(avgSaleAmount) AS avgSaleAmount, totalSales, totalEmployees FROM t_market_employees""")
def _(b): return t.market_employee_performance(t.company_employees(b.sales, b.employees))


@query("ru7_company_analytics", """
SELECT companyId, sector, revenue, salesCount, six(avgSaleAmount) AS avgSaleAmount FROM t_company""")
def _(b): return t.company_analytics(b.sales)


@query("ru8_market_analytics", """
SELECT sector, marketRevenue, marketSalesCount, six(marketAvgSale) AS marketAvgSale, totalCompanies FROM t_market""")
def _(b): return t.market_analytics(t.company_analytics(b.sales))


@query("ru9_company_brands", """
SELECT companyId, sector, brand, revenue, quantity, six(avgPrice) AS avgPrice FROM t_brands_all""")
def _(b): return t.company_brands_all(t.branded_items(b.placed_items, b.sales, b.products))


@query("ru10_company_employees", """
SELECT companyId, employeeId, sector, employeeName, revenue, salesCount, six(avgSaleAmount) AS avgSaleAmount
FROM t_employees""")
def _(b): return t.company_employees(b.sales, b.employees)


# The last minutes. The events are sparse, so the spans are wide.
RECENT = "saleTime >= (SELECT max(saleTime) FROM v_ev_sales) - INTERVAL {} MINUTE"


@query("r01_rt_summary", f"SELECT {KPI} FROM v_ev_sales WHERE {RECENT.format(600)}")
def _(b): return r.rt_summary(b.ev_sales, 600)


@query("r02_rt_by_type", f"""
SELECT saleType, count(*) AS count, CAST(sum(totalAmount) AS DOUBLE) AS revenue FROM v_ev_sales
WHERE {RECENT.format(600)} GROUP BY saleType""")
def _(b): return r.rt_by_type(b.ev_sales, 600)


@query("r03_rt_recent", f"""
SELECT saleId, saleTime, CAST(totalAmount AS DOUBLE) AS totalAmount, saleType, companyId, branchId FROM v_ev_sales
WHERE {RECENT.format(600)} ORDER BY saleTime DESC, saleId LIMIT 10""")
def _(b): return r.rt_recent(b.ev_sales, 600)


@query("r04_rt_sales_rate", f"""
SELECT strftime(saleTime, '%Y-%m-%d %H:%M') AS minute, count(*) AS count, CAST(sum(totalAmount) AS DOUBLE) AS revenue,
       round((SELECT count(*) FROM v_ev_sales WHERE {RECENT.format(600)}) / 600.0::DOUBLE, 2) AS salesPerMinute
FROM v_ev_sales WHERE {RECENT.format(600)} GROUP BY 1""")
def _(b): return r.rt_sales_rate(b.ev_sales, 600)


@query("r05_rt_top_products", f"""
SELECT i.productId, p.productName, p.brand, CAST(sum(quantity) AS BIGINT) AS totalQuantity,
       CAST(sum(subtotal) AS DOUBLE) AS totalRevenue
FROM v_ev_items i JOIN v_products p ON p.productId = i.productId
WHERE i.saleId IN (SELECT saleId FROM v_ev_sales WHERE {RECENT.format(6000)})
GROUP BY i.productId, p.productName, p.brand ORDER BY totalQuantity DESC, productId LIMIT 10""")
def _(b): return r.rt_top_products(b.ev_items, b.ev_sales, b.products, 6000)


@query("r06_activity_feed", """
SELECT s.saleId, s.saleTime, CAST(s.totalAmount AS DOUBLE) AS totalAmount, s.saleType, s.saleStatus, s.companyId,
       s.branchId, s.region, c.clientName, e.employeeName
FROM (SELECT * FROM v_ev_sales ORDER BY saleTime DESC, saleId LIMIT 50) s
LEFT JOIN v_clients c ON c.clientId = s.clientId LEFT JOIN v_employees e ON e.employeeId = s.employeeId""")
def _(b): return r.activity_feed(b.ev_sales, b.clients, b.employees)


@query("r07_ingestion_health", f"""
SELECT count(*) AS totalSales, count(*) FILTER (WHERE {RECENT.format(1)}) AS recentSales FROM v_ev_sales""")
def _(b): return r.ingestion_health(b.ev_sales)
