"""Thresholds, labels, names and merges on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesloom.functions import buckets, names
from salesloom.operators import ingest, sketch, validate
from salesloom.operators.joins import enrich_items, enrich_sales, sales_with_items
from salesloom.operators.merge import merge_keyed
from salesloom.operators.topk import page, page_info, top, top_per_group
from salesloom.plans import cells, compare, dashboard, problems, rootcause, tables


def company(spark, *rows):
    return spark.createDataFrame(list(rows), "companyId string, sector string, revenue double, salesCount long, avgSaleAmount double")


def market(spark, revenue, count, average, companies):
    return spark.createDataFrame(
        [("s", revenue, count, average, companies)],
        "sector string, marketRevenue double, marketSalesCount long, marketAvgSale double, totalCompanies long")


def found(spark, own, whole):
    rows = problems.detect_problems(company(spark, ("c", "s", *own)), market(spark, *whole)).collect()
    return {r["type"]: r["severity"] for r in rows}


@pytest.mark.parametrize("revenue, severity", [(80.0, "high"), (90.0, "medium"), (90.1, "low"), (100.0, None)])
def test_revenue_severity(spark, revenue, severity):
    assert found(spark, (revenue, 10, 10.0), (200.0, 20, 10.0, 2)).get("low_revenue") == severity


@pytest.mark.parametrize("average, present", [(8.0, False), (7.99, True)])
def test_low_average_sale_edge(spark, average, present):
    assert ("low_avg_sale" in found(spark, (100.0, 10, average), (200.0, 20, 10.0, 2))) is present


@pytest.mark.parametrize("count, present", [(80, False), (79, True)])
def test_low_sales_count_edge(spark, count, present):
    assert ("low_sales_count" in found(spark, (100.0, count, 10.0), (200.0, 200, 10.0, 2))) is present


def test_zero_denominators(spark):
    gaps = problems.company_gaps(company(spark, ("c", "s", 0.0, 0, 0.0)), market(spark, 0.0, 0, 0.0, 0)).first()
    assert (gaps.marketAvg, gaps.revenueDiff, gaps.avgSaleDiff, gaps.salesCountDiff) == (0, 0, 0, 0)
    status = problems.company_status(company(spark, ("c", "s", 0.0, 0, 0.0)), market(spark, 0.0, 0, 0.0, 0)).first()
    assert status.overallStatus == "healthy"


def test_status_and_texts(spark):
    own, whole = company(spark, ("c", "s", 1234.5, 70, 17.64)), market(spark, 4000.0, 200, 20.0, 2)
    status = problems.company_status(own, whole).first()
    assert (status.overallStatus, status.problemsCount) == ("critical", 2)
    texts = {r.type: r.description for r in problems.detect_problems(own, whole).collect()}
    assert texts["low_revenue"] == "Revenue is 38.3% below market average ($1,234.5 vs $2,000)"
    assert texts["low_sales_count"] == "Sales count is 30.0% below market average (70 vs 100)"


def sales(spark, *rows):
    """(saleId, companyId, region, totalAmount) of completed sales in one sector."""
    return spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1), c, "b1", r, "s", "retail", "completed", 1, 1, a) for i, c, r, a in rows],
        "saleId long, saleTime timestamp_ntz, companyId string, branchId string, region string, sector string, "
        "saleType string, saleStatus string, employeeId long, clientId long, totalAmount double")


@pytest.mark.parametrize("own, other, label", [
    (110.0, 90.0, "average"), (90.0, 110.0, "average"), (111.0, 89.0, "above_average"), (89.0, 111.0, "below_average")])
def test_comparison_label_edges(spark, own, other, label):
    rows = compare.compare_vs_market(sales(spark, (1, "a", "r", own), (2, "b", "r", other)))
    assert rows.filter("companyId = 'a'").first().performance == label


def test_region_problem(spark):
    rows = sales(spark, (1, "a", "north", 79.0), (2, "b", "south", 100.0), (3, "b", "gaza", 100.0))
    low = problems.detect_region_problems(rows).collect()
    assert [(r.region, r.difference) for r in low] == [("north", 21.0)]
    even = problems.detect_region_problems(sales(spark, (1, "a", "north", 80.0), (2, "b", "south", 100.0)))
    assert even.count() == 0


def base(spark, revenue=100.0, market_revenue=200.0, average=10.0, market_average=10.0):
    return rootcause.gaps(company(spark, ("c", "s", revenue, 10, average)),
                          market(spark, market_revenue, 20, market_average, 2))


def brands(spark, own, whole):
    mine = spark.createDataFrame([("c", "s", b, r) for b, r in own], "companyId string, sector string, brand string, revenue double")
    theirs = spark.createDataFrame([("s", b, r) for b, r in whole], "sector string, brand string, totalRevenue double")
    return mine, theirs


@pytest.mark.parametrize("market_share, severity", [(25.0, None), (26.0, "medium"), (36.0, "high")])
def test_brand_issue_of_same_brand(spark, market_share, severity):
    cause = rootcause.root_cause_brand(base(spark), *brands(spark, [("x", 10.0)], [("x", 2 * market_share)])).first()
    assert (cause.severity if cause else None) == severity


def test_brand_issue_by_coverage(spark):
    mine, theirs = brands(spark, [("p", 14.0), ("q", 1.0), ("x", 1.0)], [("x", 28.0), ("y", 28.0), ("z", 24.0)])
    cause = rootcause.root_cause_brand(base(spark), mine, theirs).first()
    assert (cause.severity, cause.missingBrands) == ("medium", "y,z")
    assert cause.description == "Your top 3 brands cover 16.0% of revenue vs 40.0% in market. Only 1 of your top 3 brands match market leaders."


@pytest.mark.parametrize("average, revenue, severity", [
    (11.6, 90.0, "high"), (11.6, 100.0, None), (12.1, 100.0, "high"), (8.4, 90.0, "medium"), (8.4, 100.0, None)])
def test_pricing_issue(spark, average, revenue, severity):
    cause = rootcause.root_cause_price(base(spark, revenue=revenue, average=average)).first()
    assert (cause.severity if cause else None) == severity


@pytest.mark.parametrize("above, severity", [(5, None), (4, "medium"), (2, "high")])
def test_employee_performance(spark, above, severity):
    people = spark.createDataFrame(
        [("c", i, "s", f"Name {i}", 200.0 if i < above else 50.0 + i, 1, 1.0) for i in range(10)],
        "companyId string, employeeId long, sector string, employeeName string, revenue double, salesCount long, avgSaleAmount double")
    average = spark.createDataFrame([("s", 1.0, 100.0)], "sector string, avgSalesPerEmployee double, avgRevenuePerEmployee double")
    cause = rootcause.root_cause_employee(base(spark), people, average).first()
    assert (cause.severity if cause else None) == severity
    if cause:
        assert cause.topPerformers == "Name 0,Name 1" and cause.totalEmployees == 10


def test_category_cause_and_report(spark):
    own = spark.createDataFrame([("c", "s", "a", 10.0)], "companyId string, sector string, category string, revenue double")
    whole = spark.createDataFrame([("s", "a", 72.0)], "sector string, category string, revenue double")
    cause = rootcause.root_cause_category(base(spark), own, whole)
    assert cause.first().severity == "high"
    report = rootcause.root_cause_report(base(spark), rootcause.all_causes(cause)).first()
    assert (report.totalRootCauses, report.criticalIssues, len(report.recommendations)) == (1, 1, 1)
    healthy = rootcause.root_cause_report(base(spark), rootcause.all_causes(cause.filter("severity = 'low'"))).first()
    assert (healthy.totalRootCauses, healthy.recommendations) == (0, [])


def test_revenue_cause_factors(spark):
    cause = rootcause.root_cause_revenue(base(spark, revenue=70.0, average=7.0)).first()
    assert (cause.severity, cause.factors) == ("high", "avg_sale,revenue")
    assert "Contributing factors: low average sale amount (30.0% below market), significant revenue gap. " in cause.recommendation


def test_employee_names(spark):
    rows = spark.createDataFrame([("Ann Lee - Company X", "00001234"), ("", "00001234"), ("ab12", "00001234"),
                                  (None, None), ("Sam - شركة الدواء", "1"), ("Lee - Office", "1")], "n string, i string")
    cleaned = [r[0] for r in rows.select(names.clean_employee_name(F.col("n"), F.col("i"))).collect()]
    assert cleaned == ["Ann Lee", "Employee 1234", "Employee 1234", "Unknown Employee", "Sam", "Lee - Office"]
    resolved = [r[0] for r in rows.select(names.resolve_employee_name(F.col("i"), F.lit(None).cast("string"))).collect()]
    assert resolved[0] == "Employee 1234" and resolved[3] == resolved[4] == "Unknown Employee"


def test_week_labels(spark):
    rows = spark.createDataFrame([(dt.datetime(2021, 1, 1),), (dt.datetime(2020, 12, 31),)], "t timestamp_ntz")
    assert [r[0] for r in rows.select(buckets.label("t", "weekly")).collect()] == ["2021-W53", "2020-W53"]


def test_missing_dimension(spark):
    items = spark.createDataFrame([(1, "p", "own")], "saleId long, productId string, brand string")
    row = enrich_items(items, None).first()
    assert (row.productName, row.brand) == (None, "own")
    assert enrich_sales(spark.createDataFrame([(1, 7)], "saleId long, employeeId long"), None).first().employeeName is None


def test_sale_without_lines_stays(spark):
    items = spark.createDataFrame([(1, "p", 2)], "saleId long, productId string, quantity int").withColumn("brand", F.lit("b"))
    products = spark.createDataFrame([("p", "Pen", "b")], "productId string, productName string, brand string")
    rows = sales_with_items(spark.createDataFrame([(1,), (2,)], "saleId long"), items, products).collect()
    assert sorted((r.saleId, r.productName) for r in rows if r.productName) == [(1, "Pen")] and len(rows) == 2


def test_keyed_merge(spark):
    base = spark.createDataFrame([("id1", "A", "S1", None), ("id2", "B", None, "B2"), ("id3", "C", None, None)],
                                 "productId string, productName string, sku string, barcode string")
    changes = spark.createDataFrame(
        [(1, "S1", None, "A2"), (2, None, "B2", "B3"), (3, "S9", "B2", "N"), (4, None, None, "X"), (5, None, "B9", "Y"),
         (6, "S7", "B7", "first"), (7, None, "B7", "second")],
        "seq long, sku string, barcode string, productName string")
    rows = merge_keyed(base, changes, "productId", ["sku", "barcode"]).collect()
    by_name = {r.productName: r for r in rows}
    assert by_name["A2"].productId == "id1" and by_name["A2"].action == "updated"
    assert by_name["B3"].productId == "id2" and by_name["C"].action == "unchanged"
    assert {by_name[n].action for n in ("N", "X", "Y", "second")} == {"created"}
    assert by_name["second"].sku == "S7" and "first" not in by_name and len(rows) == 7


def test_validation(spark):
    good = ("1", "p", 1, 2.0, 2.0)
    rows = spark.createDataFrame(
        [good, ("1", "p", 0, 2.0, 2.0), ("1", "p", 1, -1.0, 2.0), (None, "p", 1, 2.0, 2.0)],
        "saleId string, productId string, quantity int, price double, subtotal double")
    checked = validate.validate(rows, "sale_items")
    assert validate.accepted(checked).count() == 1
    assert sorted(r.errors[0] for r in validate.rejected(checked).collect()) == [
        "price is less than 0", "quantity is less than 1", "saleId is required"]
    status = validate.validate(spark.createDataFrame([("lost",), (None,)], "saleStatus string"), "sales").collect()
    assert [len(r.errors) for r in status] == [1, 0] and status[1].saleStatus == "completed"


def test_item_totals(spark):
    docs = spark.createDataFrame(
        [("1", None, "c", "s", [("p", 2, 5.0, 1.0, None, None, None), ("q", 1, 3.0, None, 2.5, None, None)]), ("2", None, "c", "s", None)],
        "saleId string, saleTime timestamp, companyId string, sector string, items array<struct<productId: string, "
        "quantity: int, price: double, discount: double, subtotal: double, brand: string, categoryId: string>>")
    heads, lines = ingest.split_sales(docs, "2024-01-01 00:00:00")
    assert {r.saleId: r.totalAmount for r in heads.collect()} == {"1": 11.5, "2": 0.0}
    assert lines.count() == 2
    assert {r.saleId: r.totalAmount for r in ingest.recompute_totals(heads, lines).collect()} == {"1": 11.5, "2": 0.0}


def test_sketch(spark):
    keys = spark.range(1000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), (F.col("id") % 7 + 1).cast("int").alias("n"))
    rows = keys.select("k", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    whole = sketch.cms_build(rows, "k", 64, 5)
    estimates = sketch.cms_estimate(whole, keys, "k", 64, 5).join(keys, "k")
    assert estimates.count() == 1000 and estimates.filter("estimate < n").count() == 0
    halves = sketch.cms_merge(sketch.cms_build(rows.filter("copy % 2 = 0"), "k", 64, 5),
                              sketch.cms_build(rows.filter("copy % 2 = 1"), "k", 64, 5))
    assert halves.exceptAll(whole).count() == 0 and whole.exceptAll(halves).count() == 0
    assert sketch.size_for(1e-4, 0.0067) == (27183, 6)


def test_top_k_and_pages(spark):
    rows = spark.range(103).withColumn("g", F.col("id") % 2)
    assert [r.id for r in top(rows, ["-id"], 3).collect()] == [102, 101, 100]
    assert top_per_group(rows, ["g"], ["-id"], 5).count() == 10
    assert [r.id for r in page(rows, ["id"], 3, 50).collect()] == [100, 101, 102]
    assert page_info(rows, 3, 50).first().totalPages == 3


def test_summary_falls_through(spark):
    from salesloom.operators.filters import Filters
    facts = sales(spark, (1, "a", "r", 10.0), (2, "b", "r", 30.0))
    own = tables.company_analytics(facts)
    whole = tables.market_analytics(own)
    pick = lambda f: dashboard.summary_from_tables(own, whole, f, facts).first().totalRevenue
    assert (pick(Filters(companyId="a")), pick(Filters(sector="s")), pick(Filters())) == (10.0, 40.0, 40.0)
    assert dashboard.summary_from_tables(own, whole, Filters(companyId="none"), facts).first().totalSales == 0


def test_market_is_sum_of_companies_and_shares_add_up(spark):
    facts = sales(spark, *[(i, f"c{i % 7}", "r", 10.0 + i) for i in range(50)])
    own = tables.company_analytics(facts)
    assert tables.market_analytics(own).first().marketRevenue == sum(r.revenue for r in own.collect())
    assert abs(sum(r.marketShare for r in compare.compare_vs_market(facts).collect()) - 100) < 0.1


def test_product_comparison_with_a_short_market(spark):
    """A market list shorter than k leaves room for the company's own further products."""
    kinds = "companyId string, sector string, productId string, productName string, totalRevenue double"
    own = spark.createDataFrame([("c", "s", "1", "a", 30.0), ("c", "s", "2", None, 60.0), ("d", "s", "9", "z", 10.0)], kinds)
    whole = spark.createDataFrame([("s", "1", "a", 100.0), ("s", "3", "b", 300.0)], kinds.replace("companyId string, ", ""))
    rows = {(r.companyId, r.rank): (r.productName, r.marketPercentage, r.companyRevenue)
            for r in compare.compare_products(own, whole, 3).collect()}
    assert rows == {("c", 1): ("b", 75.0, 0.0), ("c", 2): ("a", 25.0, 30.0), ("c", 3): ("2", 0.0, 60.0),
                    ("d", 1): ("b", 75.0, 0.0), ("d", 2): ("a", 25.0, 0.0), ("d", 3): ("z", 0.0, 10.0)}
    assert compare.compare_products(own, whole, 1).count() == 2


def test_hot_key(spark):
    """A third of all rows under one sale, product and company."""
    hot = F.col("id") % 3 == 0
    items = spark.range(3000).select(
        F.when(hot, 0).otherwise(F.col("id")).alias("saleId"), F.when(hot, "p").otherwise(F.concat(F.lit("p"), "id")).alias("productId"),
        F.when(hot, "big").otherwise("small").alias("companyId"), F.lit("s").alias("sector"), F.lit(1).alias("quantity"),
        F.lit(2.5).alias("price"), F.lit(2.5).alias("subtotal"), F.lit("b").alias("brand"))
    sold = tables.company_top_products(items, None)
    assert sold.filter("companyId = 'big'").collect()[0].totalRevenue == 2500.0 and sold.count() == 2001
    heads = items.select("saleId").distinct()
    products = spark.createDataFrame([("p", "Pen", "b")], "productId string, productName string, brand string")
    assert sales_with_items(heads, items.drop("companyId", "sector"), products).count() == 3000
    assert ingest.recompute_totals(heads, items).filter("saleId = 0").first().totalAmount == 2500.0


def test_company_word_behind_the_dash(spark):
    rows = spark.createDataFrame([("Ann Lee - Acme Company", 1), ("Bob - Sales Team", 2), ("Cid-Company X", 3)], "n string, i int")
    cleaned = [r[0] for r in rows.select(names.clean_employee_name(F.col("n"), F.col("i"))).collect()]
    assert cleaned == ["Ann Lee", "Bob - Sales Team", "Cid"]


def test_comparison_breaks_a_tie_at_the_last_place_by_own_revenue(spark):
    from salesloom.plans import compare
    own = spark.createDataFrame([("c", "s", 2, "b", 100.0), ("d", "s", 1, "a", 100.0)],
                                "companyId string, sector string, productId long, productName string, totalRevenue double")
    market = own.drop("companyId")
    got = {r.companyId: r.productName for r in compare.compare_products(own, market, 1).collect()}
    assert got == {"c": "b", "d": "a"}


def test_combined_market_adds_up_before_the_cut(spark):
    market = spark.createDataFrame([("s", 10.0, 1), ("t", 10.0, 1)], "sector string, marketRevenue double, totalCompanies long")
    region = spark.createDataFrame([("s", "r", 1.0, 1)], "sector string, region string, revenue double, salesCount long")
    products = spark.createDataFrame(
        [(s, p, f"p{p}", q, r) for s in "st" for p, q, r in ((1, 1, 500.0), (2, 100, 5.0))],
        "sector string, productId long, productName string, totalQuantity long, totalRevenue double")
    got = dashboard.combined_market(market, region, products, ["s", "t"], k=1).filter("section = 'topProducts'").first()
    assert (got.key, got.totalQuantity) == ("2", 200.0)


def test_topic_errors_are_undecodable_messages_only(spark):
    from salesloom.sources.events import topic_stats
    rows = spark.createDataFrame([("t", '{"_id": "1"}'), ("t", '{"_id": "2", "eventType": "x"}'), ("t", '{"_id": ')],
                                 "topic string, value string")
    assert topic_stats(rows).first().errors == 1


def test_first_copy_of_an_id(spark):
    from salesloom.streaming.dedup import dedup_events
    rows = spark.createDataFrame([(1, "2024-01-01 00:05:00", 2.0), (1, "2024-01-01 00:00:00", 9.0), (2, None, 1.0)],
                                 "saleId int, saleTime string, amount double")
    assert {r.saleId: r.amount for r in dedup_events(rows, ["saleId"]).collect()} == {1: 9.0, 2: 1.0}


def test_pages_by_the_last_key_follow_each_other(spark):
    from salesloom.operators.topk import page_after
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else float(i % 5)) for i in range(40)], "id int, x double")
    want, got, last = [r.id for r in top(rows, ["-x", "id"]).collect()], [], None
    while found := page_after(rows, ["-x", "id"], last, 9).collect():
        got, last = got + [r.id for r in found], found[-1].asDict()
    assert got == want


def test_average_price_keeps_small_prices(spark):
    from salesloom.functions.measures import total
    from salesloom.operators.grouping import group_with_texts
    rows = spark.createDataFrame([(1, "a", 0.00001), (1, "b", 0.00002), (1, "a", 0.00001)], "k int, t string, price double")
    got = group_with_texts(rows, ["k"], ["t"], {"p": F.sum("price")}, plain=["p"]).first()
    assert abs(got.p - 0.00004) < 1e-12


def test_advice_names_products_else_brands_else_neither(spark):
    company = spark.createDataFrame([(c, "s", 10.0, 5, 2.0) for c in "pbn"] + [("big", "s", 900.0, 50, 18.0)],
                                    "companyId string, sector string, revenue double, salesCount long, avgSaleAmount double")
    market = spark.createDataFrame([("s", 930.0, 65, 14.3, 4)], "sector string, marketRevenue double, marketSalesCount long, "
                                   "marketAvgSale double, totalCompanies long")
    products = spark.createDataFrame([("p", "s", n, v) for n, v in (("x", 1.0), ("y", 3.0), (None, 2.0), ("z", 0.5))],
                                     "companyId string, sector string, productName string, totalRevenue double")
    brands = spark.createDataFrame([("b", "s", "acme", 3.0), ("p", "s", "acme", 3.0)],
                                   "companyId string, sector string, brand string, revenue double")
    rows = problems.detect_problems(company, market, sellers=problems.best_sellers(products, brands)).collect()
    advice = {(r.companyId, r.type): r.recommendation for r in rows}
    assert "top products: y, Unknown, x. Consider" in advice["p", "low_revenue"]
    assert "upselling top products: y, Unknown, x." in advice["p", "low_avg_sale"]
    assert advice["b", "low_revenue"].startswith("Focus on top brands: acme.")
    assert advice["n", "low_revenue"].startswith("Investigate pricing strategy")
    assert all("Consider upselling strategies" in advice[c, "low_avg_sale"] for c in "bn")


def test_market_percentages_are_of_the_whole_revenue(spark):
    own = spark.createDataFrame([("c", "s", 1, "a", 6.0)],
                                "companyId string, sector string, productId long, productName string, totalRevenue double")
    whole = own.drop("companyId")
    for revenue, want in ((24.0, 25.0), (0.0, 100.0), (None, 100.0)):
        market = spark.createDataFrame([("s", revenue)], "sector string, marketRevenue double")
        assert compare.compare_products(own, whole, 3, market).first().marketPercentage == want
    assert compare.compare_products(own, whole, 3).first().marketPercentage == 100.0


def test_cells_give_the_tables_of_the_lines(spark):
    """Roll-ups of the cells equal what the lines give, with odd brands, prices and statuses."""
    rng = random.Random(3)
    sales = spark.createDataFrame([(i, f"c{i % 3}" if i % 7 else None, "s" if i % 5 else None,
                                    "completed" if i % 4 else "pending") for i in range(60)],
                                  "saleId long, companyId string, sector string, saleStatus string")
    items = spark.createDataFrame([(rng.randrange(70), rng.choice([None, 1, 2, 3, 9]), rng.randrange(1, 5),
                                    rng.randrange(1, 10 ** 6) / 10000, rng.choice(["x", "y", "", None]), rng.choice("kl"))
                                   for _ in range(400)],
                                  "saleId long, productId long, quantity int, subtotal double, brand string, categoryId string")
    products = spark.createDataFrame([(1, "one", "x", 2.5), (2, "two", None, None), (3, "three", "", 4.0)],
                                     "productId long, productName string, brand string, productPrice double")
    cell = cells.item_cells(items, sales)

    def rows(df, *columns):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=str)

    placed = items.join(sales.select("saleId", "companyId", "sector"), "saleId")
    branded = tables.branded_items(placed, sales, products)
    want = tables.company_brands_all(branded)
    pair = ["companyId", "sector", "brand", "revenue", "quantity", "avgPrice"]
    assert rows(cells.company_brands(cell, products), *pair) == rows(want, *pair)
    both = ["sector", "brand", "totalRevenue", "maxQuantity", "productCount"]
    assert rows(cells.market_brands(cell, products), *both) == rows(tables.market_top_brands(want, branded), *both)
    plain = ["companyId", "sector", "productId", "productName", "totalRevenue", "totalQuantity", "avgPrice"]
    by_product = cells.item_cells(items, sales, ["productId"])
    assert rows(cells.company_products(by_product, products), *plain) == rows(
        tables.company_top_products(placed, products), *plain)
