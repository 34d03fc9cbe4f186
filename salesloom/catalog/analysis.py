"""Comparisons, problems and root causes, for all companies."""

from __future__ import annotations

from salesloom.catalog.registry import query
from salesloom.plans import cells
from salesloom.plans import compare as c
from salesloom.plans import problems as p
from salesloom.plans import rootcause as rc
from salesloom.plans import tables as t
from salesloom.session import staged
from salesloom.catalog.bindings import shop_sql
from salesloom.functions.measures import total
from salesloom.operators.filters import completed
from salesloom.operators.joins import items_with_sale


def pair(b):
    company = t.company_analytics(b.sales)
    return company, t.market_analytics(company)


def two(expr: str) -> str:
    return f"floor(({expr}) * 100 + 0.5) / 100"


def compare_sql(keys: str, share: str, average: str, sale: str) -> str:
    on = " AND ".join(f"o.{k} = m.{k}" for k in keys.split(", "))
    own = ", ".join(f"o.{k}" for k in keys.split(", "))
    return f"""
SELECT companyId, {keys}, revenue, salesCount, six(avgSaleAmount) AS avgSaleAmount, totalRevenue, totalSales,
       six(marketAvgSale) AS marketAvgSale, companiesCount, round(revenue / totalRevenue * 100, 2) AS {share},
       round(vs, 2) AS {average}, round((avgSaleAmount - marketAvgSale) / marketAvgSale * 100, 2) AS {sale},
       CASE WHEN vs > 10 THEN 'above_average' WHEN vs < -10 THEN 'below_average' ELSE 'average' END AS performance
FROM (SELECT o.companyId, {own}, o.revenue, o.salesCount, o.revenue / o.salesCount AS avgSaleAmount, m.totalRevenue,
             m.totalSales, m.totalRevenue / m.totalSales AS marketAvgSale, m.companiesCount,
             (o.revenue - m.totalRevenue / m.companiesCount) / (m.totalRevenue / m.companiesCount) * 100 AS vs
      FROM (SELECT companyId, {keys}, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount
            FROM v_sales WHERE saleStatus = 'completed' GROUP BY companyId, {keys}) o
      JOIN (SELECT {keys}, CAST(sum(totalAmount) AS DOUBLE) AS totalRevenue, count(*) AS totalSales,
                   count(DISTINCT companyId) AS companiesCount
            FROM v_sales WHERE saleStatus = 'completed' GROUP BY {keys}) m ON {on})"""


@query("c01_compare_vs_market", compare_sql("sector", "marketShare", "revenueVsMarketAvg", "avgSaleVsMarket"))
def _(b): return c.compare_vs_market(b.sales)


@query("c02_compare_vs_region", compare_sql("sector, region", "regionShare", "revenueVsRegionAvg", "avgSaleVsRegion"))
def _(b): return c.compare_vs_region(b.sales)


@query("c03_company_trend", """
SELECT companyId, sector, strftime(saleTime, '%Y-%m') AS bucket, CAST(sum(totalAmount) AS DOUBLE) AS revenue,
       count(*) AS salesCount FROM v_sales WHERE saleStatus = 'completed' GROUP BY 1, 2, 3""")
def _(b): return c.company_trend(b.sales, "monthly")


@query("c04_market_trend", """
SELECT sector, strftime(saleTime, '%Y-W%V') AS bucket, CAST(sum(totalAmount) AS DOUBLE) AS revenue,
       count(*) AS salesCount, six(CAST(sum(totalAmount) AS DOUBLE) / count(DISTINCT companyId)) AS avgRevenue
FROM v_sales WHERE saleStatus = 'completed' GROUP BY 1, 2""")
def _(b): return c.market_trend(b.sales, "week")


@query("c05_compare_products", """
WITH own AS (SELECT companyId, sector, coalesce(productName, CAST(productId AS STRING)) AS productName,
                    totalRevenue AS companyRevenue FROM t_company_products),
market AS (SELECT sector, coalesce(productName, CAST(productId AS STRING)) AS productName,
                  totalRevenue AS marketRevenue FROM t_market_products),
companies AS (SELECT companyId, sector, CAST(sum(CAST(companyRevenue AS DECIMAL(28,4))) AS DOUBLE) AS companyTotal
              FROM own GROUP BY companyId, sector),
markets AS (SELECT m.sector, coalesce(nullif(any_value(t.marketRevenue), 0),
                     CAST(sum(CAST(m.marketRevenue AS DECIMAL(28,4))) AS DOUBLE)) AS marketTotal
            FROM market m LEFT JOIN t_market t ON t.sector = m.sector GROUP BY m.sector),
every AS (SELECT c.companyId, c.sector, m.productName, m.marketRevenue, coalesce(o.companyRevenue, 0) AS companyRevenue,
                 c.companyTotal, t.marketTotal,
                 row_number() OVER (PARTITION BY c.companyId, c.sector
                                    ORDER BY m.marketRevenue DESC, coalesce(o.companyRevenue, 0) DESC, m.productName) AS rank
          FROM companies c JOIN market m ON m.sector = c.sector JOIN markets t ON t.sector = c.sector
          LEFT JOIN own o ON o.companyId = c.companyId AND o.sector = c.sector AND o.productName = m.productName)
SELECT companyId, sector, CAST(rank AS INT) AS rank, productName, marketRevenue,
       six(marketRevenue / marketTotal * 100) AS marketPercentage, companyRevenue,
       six(companyRevenue / companyTotal * 100) AS companyPercentage
FROM every WHERE rank <= 10""")
def _(b):
    sold = cells.item_cells(b.items, b.sales, ["productId"])
    company = cells.company_products(sold, b.products)
    return c.compare_products(company, cells.market_products(sold, b.products), market_revenue=pair(b)[1])


@query("p01_company_gaps", """
SELECT companyId, sector, revenue, salesCount, six(avgSaleAmount) AS avgSaleAmount, marketRevenue, marketSalesCount,
       six(marketAvgSale) AS marketAvgSale, totalCompanies, six(marketAvg) AS marketAvg,
       six(marketAvgSalesCount) AS marketAvgSalesCount, six(revenueDiff) AS revenueDiff,
       six(avgSaleDiff) AS avgSaleDiff, six(salesCountDiff) AS salesCountDiff FROM t_gaps""")
def _(b): return p.company_gaps(*pair(b))


SEVERITY = "CASE WHEN abs(revenueDiff) >= 20 THEN 'high' WHEN abs(revenueDiff) >= 10 THEN 'medium' ELSE 'low' END"
P2 = f"""SELECT companyId, sector, 'low_revenue' AS type, {SEVERITY} AS severity, six(revenue) AS currentValue,
       six(marketAvg) AS marketValue, round(abs(revenueDiff), 1) AS difference FROM t_gaps WHERE hasRevenueProblem"""
P3 = """SELECT companyId, sector, 'low_avg_sale' AS type, 'medium' AS severity, six(avgSaleAmount) AS currentValue,
       six(marketAvgSale) AS marketValue, round((1 - avgSaleAmount / marketAvgSale) * 100, 1) AS difference
FROM t_gaps WHERE avgSaleAmount < marketAvgSale * 0.8::DOUBLE"""
P4 = """SELECT companyId, sector, 'low_sales_count' AS type, 'high' AS severity, CAST(salesCount AS DOUBLE) AS currentValue,
       six(marketAvgSalesCount) AS marketValue, round(abs(salesCountDiff), 1) AS difference
FROM t_gaps WHERE salesCountDiff < -20"""
METRICS = ["companyId", "sector", "type", "severity", "currentValue", "marketValue", "difference"]


def problems(b, kind=None):
    rows = p.detect_problems(*pair(b), p.employee_stats(b.sales)).select(*METRICS)
    return rows if kind is None else rows.filter(rows["type"] == kind)


@query("p02_low_revenue", P2)
def _(b): return problems(b, "low_revenue")


@query("p02_advice", """
WITH named AS (SELECT companyId, sector, string_agg(name, ', ' ORDER BY r) AS names FROM (
  SELECT companyId, sector, coalesce(productName, 'Unknown') AS name, row_number() OVER (
    PARTITION BY companyId, sector ORDER BY totalRevenue DESC, coalesce(productName, 'Unknown')) AS r FROM t_company_products)
  WHERE r <= 3 GROUP BY companyId, sector)
SELECT g.companyId, g.sector, 'Focus on promoting top products: ' || names || '. Consider increasing inventory for these high-performing items and running targeted promotions.' AS recommendation
FROM t_gaps g JOIN named n ON n.companyId = g.companyId AND n.sector = g.sector WHERE hasRevenueProblem""")
def _(b):
    """The advice of a revenue problem with the best selling products."""
    sellers = p.best_sellers(cells.company_products(cells.item_cells(b.items, b.sales, ["productId"]), b.products))
    rows = p.detect_problems(*pair(b), sellers=sellers)
    return rows.filter(rows["type"] == "low_revenue").select("companyId", "sector", "recommendation")


@query("p03_low_avg_sale", P3)
def _(b): return problems(b, "low_avg_sale")


@query("p03_low_avg_sale_shops", shop_sql(P3))
def _(b): return problems(b.shops(), "low_avg_sale")


@query("p04_low_sales_count", P4)
def _(b): return problems(b, "low_sales_count")


@query("p05_employee_stats", """
SELECT companyId, sector, six(avg(n)) AS avgSalesPerEmployee, count(*) AS totalEmployees
FROM (SELECT companyId, sector, employeeId, count(*) AS n FROM v_sales
      WHERE saleStatus = 'completed' AND employeeId IS NOT NULL GROUP BY 1, 2, 3) GROUP BY companyId, sector""")
def _(b): return p.employee_stats(b.sales)


@query("p06_detect_problems", f"{P2} UNION ALL {P3} UNION ALL {P4}")
def _(b): return problems(b)


@query("p06_problem_texts", """
SELECT g.companyId, g.sector, 'low_sales_count' AS type,
       printf('Sales count is %.1f%% below market average (%d vs %d)', floor(abs(salesCountDiff) * 10 + 0.5) / 10, salesCount,
              CAST(round(marketAvgSalesCount) AS BIGINT)) AS description,
       printf('You have %d sales vs market average of %d. ', salesCount, CAST(round(marketAvgSalesCount) AS BIGINT)) ||
       printf('Your employees average %.1f sales each. Consider employee training, performance incentives, or increasing staff during peak hours.', floor(e.a * 10 + 0.5) / 10) AS recommendation
FROM t_gaps g JOIN (SELECT companyId, sector, avg(n) AS a FROM
  (SELECT companyId, sector, employeeId, count(*) AS n FROM v_sales
   WHERE saleStatus = 'completed' AND employeeId IS NOT NULL GROUP BY 1, 2, 3) GROUP BY companyId, sector) e
  ON e.companyId = g.companyId AND e.sector = g.sector WHERE salesCountDiff < -20""")
def _(b):
    rows = p.detect_problems(*pair(b), p.employee_stats(b.sales))
    return rows.filter(rows["type"] == "low_sales_count").select(
        "companyId", "sector", "type", "description", "recommendation")


@query("p06_company_status", f"""
WITH found AS ({P2} UNION ALL {P3} UNION ALL {P4}),
counted AS (SELECT companyId, sector, count(*) AS n, count(*) FILTER (WHERE severity = 'high') AS high
            FROM found GROUP BY companyId, sector)
SELECT g.companyId, g.sector, g.revenue, g.salesCount, six(g.avgSaleAmount) AS avgSaleAmount,
       six(g.marketAvg) AS marketRevenue, CAST(round(g.marketAvgSalesCount) AS BIGINT) AS marketSalesCount,
       six(g.marketAvgSale) AS marketAvgSale, CAST(coalesce(c.n, 0) AS INT) AS problemsCount,
       CASE WHEN coalesce(c.n, 0) = 0 THEN 'healthy' WHEN c.high > 0 THEN 'critical' ELSE 'warning' END AS overallStatus
FROM t_gaps g LEFT JOIN counted c ON c.companyId = g.companyId AND c.sector = g.sector""")
def _(b): return p.company_status(*pair(b), p.employee_stats(b.sales))


# Regions of both data sets: customers are spread evenly over the first, unevenly over the second.
REGION = """
SELECT *, CASE WHEN marketRevenue > 0 THEN (revenue - marketRevenue) / marketRevenue * 100 ELSE 0 END AS revenueDiff
FROM (SELECT a.sector, a.region, a.revenue, a.salesCount, a.revenue / a.salesCount AS avgSaleAmount, a.companiesCount,
             CAST(sum(CAST(o.revenue AS DECIMAL(28,4))) AS DOUBLE) / count(*) AS marketRevenue,
             CAST(round(sum(o.salesCount)::DOUBLE / count(*)) AS BIGINT) AS marketSalesCount,
             CAST(sum(CAST(o.revenue AS DECIMAL(28,4))) AS DOUBLE) / sum(o.salesCount) AS marketAvgSale
      FROM r a JOIN r o ON o.sector = a.sector AND o.region <> a.region GROUP BY ALL)"""
REGION_BASE = """WITH r AS (SELECT sector, region, CAST(sum(totalAmount) AS DOUBLE) AS revenue, count(*) AS salesCount,
       count(DISTINCT companyId) AS companiesCount FROM {} WHERE saleStatus = 'completed' GROUP BY sector, region)"""


@query("p07_region_gaps", f"""{REGION_BASE.format('v_sales')}
SELECT sector, region, revenue, salesCount, six(avgSaleAmount) AS avgSaleAmount, companiesCount,
       six(marketRevenue) AS marketRevenue, marketSalesCount, six(marketAvgSale) AS marketAvgSale,
       six(revenueDiff) AS revenueDiff FROM ({REGION})""")
def _(b): return p.region_gaps(b.sales)


@query("p07_region_problems", f"""{REGION_BASE.format('v_ev_sales')}
SELECT sector, region, 'low_region_performance' AS type, 'high' AS severity, revenue, six(marketRevenue) AS marketRevenue,
       round(abs(revenueDiff), 1) AS difference FROM ({REGION}) WHERE revenueDiff < -20""")
def _(b): return p.detect_region_problems(b.ev_sales).drop("description", "recommendation")


# Root causes.
def brands(b):
    return t.company_brands_all(t.branded_items(b.placed_items, b.sales, b.products))


def causes(b):
    """Base and causes. The facts are passed over once per result table; the rules read the stored tables."""
    company = staged(t.company_analytics(b.sales), "company")
    market = t.market_analytics(company)
    base = rc.gaps(company, market)
    all_brands = staged(brands(b), "brands")
    people = staged(t.company_employees(b.sales, b.employees), "employees")
    per_employee = rc.employee_market_avg(market, t.market_employee_performance(people))
    own = staged(company_categories(b), "categories")
    return base, rc.all_causes(
        rc.root_cause_revenue(base), rc.root_cause_brand(base, all_brands, t.market_top_brands(all_brands)),
        rc.root_cause_price(base), rc.root_cause_employee(base, people, per_employee),
        rc.root_cause_category(base, own, cells.market_categories(own)))


def company_categories(b):
    rows = items_with_sale(b.items, completed(b.sales), ["companyId", "sector"])
    return rows.groupBy("companyId", "sector", rows["categoryId"].alias("category")).agg(
        total("subtotal").alias("revenue"))


BRANDS_SQL = """
own AS (SELECT *, row_number() OVER (PARTITION BY companyId, sector ORDER BY revenue DESC, brand) AS r FROM t_brands_all),
mkt AS (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY totalRevenue DESC, brand) AS r FROM t_market_brands)"""


@query("rc01_brand_shares", f"""
WITH {BRANDS_SQL}
SELECT o.companyId, o.sector, 'company' AS side, CAST(r AS INT) AS rank, o.brand, o.revenue,
       six(o.revenue / c.revenue * 100) AS percentage
FROM own o JOIN t_gaps c ON c.companyId = o.companyId AND c.sector = o.sector WHERE r <= 5
UNION ALL
SELECT c.companyId, m.sector, 'market', CAST(r AS INT), m.brand, m.totalRevenue, six(m.totalRevenue / c.marketRevenue * 100)
FROM mkt m JOIN t_gaps c ON c.sector = m.sector WHERE r <= 10""")
def _(b):
    all_brands = brands(b)
    return rc.brand_shares(rc.gaps(*pair(b)), all_brands, t.market_top_brands(all_brands))


def leaders_sql(own: str, market: str, name: str, market_revenue: str) -> str:
    """First three of each company and of each market, as lists."""
    return f"""
o3 AS (SELECT companyId, sector, list({name} ORDER BY r) AS names, min({name}) FILTER (WHERE r = 1) AS top,
              min(revenue) FILTER (WHERE r = 1) AS topRevenue, sum(revenue ORDER BY r) AS rev3
       FROM {own} WHERE r <= 3 GROUP BY companyId, sector),
m3 AS (SELECT sector, list({name} ORDER BY r) AS names, min({name}) FILTER (WHERE r = 1) AS top,
              min({market_revenue}) FILTER (WHERE r = 1) AS topRevenue, sum({market_revenue} ORDER BY r) AS rev3
       FROM {market} WHERE r <= 3 GROUP BY sector),
x AS (SELECT g.companyId, g.sector, o3.top AS ownTop, m3.top AS marketTop, o3.topRevenue AS ownRevenue,
             m3.topRevenue AS marketRevenue, o3.topRevenue / g.revenue * 100 AS ownShare,
             m3.topRevenue / g.marketRevenue * 100 AS marketShare, o3.rev3 / g.revenue * 100 AS ownCoverage,
             m3.rev3 / g.marketRevenue * 100 AS marketCoverage, o3.names AS ownNames, m3.names AS marketNames,
             list_filter(m3.names, lambda n: list_contains(o3.names, n)) AS common,
             list_filter(m3.names, lambda n: NOT list_contains(o3.names, n)) AS missing
      FROM t_gaps g JOIN o3 ON o3.companyId = g.companyId AND o3.sector = g.sector JOIN m3 ON m3.sector = g.sector)"""


BRAND_CAUSE = f"""
{BRANDS_SQL}, {leaders_sql('own', 'mkt', 'brand', 'totalRevenue')},
brand_cause AS (SELECT companyId, sector, 'brand_issue' AS type,
    CASE WHEN ownShare - marketShare < -15 THEN CASE WHEN abs(ownShare - marketShare) > 25 THEN 'high' ELSE 'medium' END
         WHEN marketCoverage - ownCoverage > 30 THEN 'high' ELSE 'medium' END AS severity,
    ownTop AS companyTopBrand, marketTop AS marketTopBrand, six(ownRevenue) AS companyBrandRevenue,
    six(marketRevenue) AS marketBrandRevenue, six(ownShare) AS companyBrandPercentage,
    six(marketShare) AS marketBrandPercentage, six(marketCoverage - ownCoverage) AS coverageGap,
    array_to_string(ownNames, ',') AS top3CompanyBrands, array_to_string(marketNames, ',') AS top3MarketBrands,
    array_to_string(missing, ',') AS missingBrands, ownTop = marketTop AS sameBrand
  FROM x WHERE ownShare - marketShare < -15 OR (len(common) < 2 AND marketCoverage - ownCoverage > 20))"""


@query("rc02_root_cause_brand", f"WITH {BRAND_CAUSE} SELECT * FROM brand_cause")
def _(b):
    all_brands = brands(b)
    return rc.root_cause_brand(rc.gaps(*pair(b)), all_brands, t.market_top_brands(all_brands)).drop(
        "description", "recommendation")


@query("rc02_root_cause_brand_shops", shop_sql(f"WITH {BRAND_CAUSE} SELECT * FROM brand_cause"))
def _(b):
    b = b.shops()
    all_brands = brands(b)
    return rc.root_cause_brand(rc.gaps(*pair(b)), all_brands, t.market_top_brands(all_brands)).drop(
        "description", "recommendation")


REVENUE_CAUSE = f"""
SELECT companyId, sector, 'low_revenue' AS type, {SEVERITY} AS severity, revenue, round(marketAvg) AS marketAverage,
       six(revenueDiff) AS revenueDiff, salesCount, CAST(round(marketAvgSalesCount) AS BIGINT) AS marketAvgSalesCount,
       six(avgSaleAmount) AS avgSaleAmount, six(marketAvgSale) AS marketAvgSale,
       concat_ws(',', CASE WHEN avgSaleDiff < -10 THEN 'avg_sale' END, CASE WHEN salesCountDiff < -10 THEN 'sales_count' END,
                 CASE WHEN revenueDiff < -20 THEN 'revenue' END) AS factors
FROM t_gaps WHERE hasRevenueProblem"""


@query("rc03_root_cause_revenue", REVENUE_CAUSE)
def _(b): return rc.root_cause_revenue(rc.gaps(*pair(b))).drop("description", "recommendation")


PRICE_CAUSE = """
SELECT companyId, sector, 'pricing_issue' AS type, CASE WHEN avgSaleDiff > 0 THEN 'high' ELSE 'medium' END AS severity,
       six(avgSaleAmount) AS companyAvgPrice, six(marketAvgSale) AS marketAvgPrice, six(avgSaleDiff) AS priceDifference
FROM t_gaps WHERE abs(avgSaleDiff) > CASE WHEN hasRevenueProblem THEN 15 ELSE 20 END"""


@query("rc04_root_cause_price", PRICE_CAUSE)
def _(b): return rc.root_cause_price(rc.gaps(*pair(b))).drop("description", "recommendation")


PER_EMPLOYEE = """
SELECT m.sector, e.totalSales::DOUBLE / e.totalEmployees AS avgSalesPerEmployee,
       m.marketRevenue / e.totalEmployees AS avgRevenuePerEmployee
FROM t_market m JOIN t_market_employees e ON e.sector = m.sector"""


@query("rc05_employee_market_avg", f"""
SELECT sector, six(avgSalesPerEmployee) AS avgSalesPerEmployee, six(avgRevenuePerEmployee) AS avgRevenuePerEmployee
FROM ({PER_EMPLOYEE})""")
def _(b):
    return rc.employee_market_avg(pair(b)[1], t.market_employee_performance(t.company_employees(b.sales, b.employees)))


EMPLOYEE_CAUSE = f"""
per_employee AS ({PER_EMPLOYEE}),
first10 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY companyId ORDER BY revenue DESC, employeeId) AS r
            FROM t_employees) WHERE r <= 10),
weighed AS (SELECT g.companyId, g.sector, f.employeeName, f.employeeId, f.revenue, p.avgRevenuePerEmployee AS average,
                   f.revenue > p.avgRevenuePerEmployee AS above
            FROM t_gaps g JOIN per_employee p ON p.sector = g.sector JOIN first10 f ON f.companyId = g.companyId),
employee_cause AS (SELECT companyId, sector, 'employee_performance' AS type,
    CASE WHEN count(*) FILTER (WHERE above) * 100.0::DOUBLE / count(*) < 30 THEN 'high' ELSE 'medium' END AS severity,
    count(*) FILTER (WHERE above) AS employeesAboveMarket, count(*) AS totalEmployees,
    six(count(*) FILTER (WHERE above)::DOUBLE / count(*) * 100) AS employeesAboveMarketPercentage,
    six(CAST(sum(CAST(revenue AS DECIMAL(28,4))) AS DOUBLE) / count(*)) AS companyAvgRevenuePerEmployee,
    six(max(average)) AS marketAvgRevenuePerEmployee,
    coalesce(array_to_string(list_slice(list(employeeName ORDER BY revenue DESC, CAST(employeeId AS STRING)) FILTER (WHERE above), 1, 2), ','), '') AS topPerformers,
    coalesce(array_to_string(list_slice(list(employeeName ORDER BY revenue, CAST(employeeId AS STRING)) FILTER (WHERE NOT above), 1, 2), ','), '') AS lowPerformers
  FROM weighed GROUP BY companyId, sector HAVING count(*) FILTER (WHERE above) * 2 < count(*))"""


@query("rc06_root_cause_employee", f"WITH {EMPLOYEE_CAUSE} SELECT * FROM employee_cause")
def _(b):
    company, market = pair(b)
    people = t.company_employees(b.sales, b.employees)
    per_employee = rc.employee_market_avg(market, t.market_employee_performance(people))
    return rc.root_cause_employee(rc.gaps(company, market), people, per_employee).drop("description", "recommendation")


@query("rc06_root_cause_employee_shops", shop_sql(f"WITH {EMPLOYEE_CAUSE} SELECT * FROM employee_cause"))
def _(b):
    b = b.shops()
    company, market = pair(b)
    people = t.company_employees(b.sales, b.employees)
    per_employee = rc.employee_market_avg(market, t.market_employee_performance(people))
    return rc.root_cause_employee(rc.gaps(company, market), people, per_employee).drop("description", "recommendation")


CATEGORY_CAUSE = f"""
ownc AS (SELECT companyId, sector, categoryId, CAST(sum(subtotal) AS DOUBLE) AS revenue,
                row_number() OVER (PARTITION BY companyId, sector ORDER BY CAST(sum(subtotal) AS DOUBLE) DESC, categoryId) AS r
         FROM v_placed WHERE saleStatus = 'completed' GROUP BY companyId, sector, categoryId),
mktc AS (SELECT sector, categoryId, CAST(sum(subtotal) AS DOUBLE) AS totalRevenue,
                row_number() OVER (PARTITION BY sector ORDER BY CAST(sum(subtotal) AS DOUBLE) DESC, categoryId) AS r
         FROM v_placed WHERE saleStatus = 'completed' GROUP BY sector, categoryId),
{leaders_sql('ownc', 'mktc', 'categoryId', 'totalRevenue').replace('o3', 'oc3').replace('m3', 'mc3').replace('x AS', 'xc AS')},
category_cause AS (SELECT companyId, sector, 'product_category' AS type,
    CASE WHEN ownTop = marketTop AND ownShare - marketShare < -25 THEN 'high' ELSE 'medium' END AS severity,
    ownTop AS companyTopCategory, marketTop AS marketTopCategory, six(ownRevenue) AS companyCategoryRevenue,
    six(marketRevenue) AS marketCategoryRevenue, six(ownShare) AS companyCategoryPercentage,
    six(marketShare) AS marketCategoryPercentage, array_to_string(ownNames, ',') AS top3CompanyCategories,
    array_to_string(marketNames, ',') AS top3MarketCategories, array_to_string(missing, ',') AS missingCategories,
    ownTop = marketTop AS sameCategory
  FROM xc WHERE ownTop <> marketTop OR ownShare - marketShare < -20)"""


@query("rc07_root_cause_category", f"WITH {CATEGORY_CAUSE} SELECT * FROM category_cause")
def _(b):
    own = company_categories(b)
    return rc.root_cause_category(rc.gaps(*pair(b)), own, cells.market_categories(own)).drop("description", "recommendation")


CAUSES_SQL = f"""
WITH {BRAND_CAUSE}, {EMPLOYEE_CAUSE}, {CATEGORY_CAUSE},
causes AS (SELECT companyId, sector, type, severity FROM brand_cause
  UNION ALL SELECT companyId, sector, type, severity FROM ({REVENUE_CAUSE})
  UNION ALL SELECT companyId, sector, type, severity FROM ({PRICE_CAUSE})
  UNION ALL SELECT companyId, sector, type, severity FROM employee_cause
  UNION ALL SELECT companyId, sector, type, severity FROM category_cause)"""


@query("rc09_root_causes", f"{CAUSES_SQL} SELECT * FROM causes")
def _(b): return causes(b)[1].select("companyId", "sector", "type", "severity")


@query("rc09_root_cause_report", f"""{CAUSES_SQL}
SELECT g.companyId, g.sector, count(c.type) AS totalRootCauses, count(*) FILTER (WHERE c.severity = 'high') AS criticalIssues,
       coalesce(string_agg(c.type, ',' ORDER BY c.type), '') AS types, count(c.type) AS recommendationsCount
FROM t_gaps g LEFT JOIN causes c ON c.companyId = g.companyId AND c.sector = g.sector GROUP BY g.companyId, g.sector""")
def _(b):
    from pyspark.sql import functions as F
    return rc.root_cause_report(*causes(b)).withColumn(
        "recommendationsCount", F.size("recommendations").cast("bigint")).drop("recommendations")


@query("rc09_employee_shares", f"""
WITH {EMPLOYEE_CAUSE}
SELECT f.companyId, g.sector, CAST(f.r AS INT) AS rank, f.employeeId, f.employeeName, f.revenue, f.salesCount,
       six(f.avgSaleAmount) AS avgSaleAmount, six(f.revenue / g.revenue * 100) AS percentage
FROM first10 f JOIN t_gaps g ON g.companyId = f.companyId WHERE f.r <= 5""")
def _(b): return rc.employee_shares(rc.gaps(*pair(b)), t.company_employees(b.sales, b.employees))


@query("rc10_examined", """
SELECT DISTINCT companyId, sector, true AS examined FROM v_sales s WHERE EXISTS (
  SELECT 1 FROM v_sales d WHERE d.companyId = s.companyId AND d.sector = s.sector AND d.saleStatus = 'completed')""")
def _(b):
    from pyspark.sql import functions as F
    pairs = b.sales.select("companyId", "sector").distinct()
    return p.with_sales(pairs, t.company_analytics(b.sales)).withColumn("examined", F.lit(True))
