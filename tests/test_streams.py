"""Late rows, replays, update mode, compaction and running several streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesloom import session
from salesloom.catalog.bindings import Tables
from salesloom.catalog.streams import closed_inputs, inputs
from salesloom.operators import sketch
from salesloom.operators.filters import with_brand
from salesloom.plans import tables
from salesloom.streaming import ledger, runner, windowed
from salesloom.streaming.dedup import dedup_events

FOLDER = "/root/testdata/sf0.001"
SALES = ("saleId string, saleTime timestamp, totalAmount double, companyId string, region string, sector string, "
         "saleStatus string, employeeId string")
REGION = runner.BY_NAME["region"].columns


def sale(i, time, amount=1.0, company="c", employee="e"):
    return (str(i), dt.datetime.fromisoformat(f"2024-01-01 {time}"), amount, company, "r", "s", "completed", employee)


def windows(spark, *rows):
    return spark.createDataFrame(
        [("r", "s", dt.datetime.fromisoformat(f"2024-01-01 {a}"), dt.datetime.fromisoformat(f"2024-01-01 {b}"), v, n)
         for a, b, v, n in rows],
        "region string, sector string, window_start timestamp, window_end timestamp, revenue double, salesCount long")


def test_late_rows_are_dropped(spark):
    folder, root = session.work_folder(spark, "late"), session.work_folder(spark, "late")

    def run():
        stream = spark.readStream.schema(SALES).option("maxFilesPerTrigger", 1).parquet(folder)
        (windowed.company_windows(stream).writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).foreachBatch(lambda df, n: ledger.write_batch(df, n, root)).start().awaitTermination())

    spark.createDataFrame([sale(1, "10:00:05"), sale(2, "10:10:00")], SALES).coalesce(1).write.parquet(folder)
    run()
    spark.createDataFrame([sale(3, "10:00:10"), sale(4, "10:09:00", 5.0), sale(5, "11:00:00")], SALES).coalesce(1) \
        .write.mode("append").parquet(folder)
    run()
    got = {r.window_start.strftime("%H:%M"): r.revenue for r in spark.read.parquet(f"{root}/batches").collect()}
    assert got == {"10:00": 1.0, "10:09": 5.0, "10:10": 1.0}


def test_replay_leaves_the_table_unchanged(spark):
    root = session.work_folder(spark, "replay")
    ledger.write_batch(windows(spark, ("10:00", "10:01", 10.0, 1)), 0, root)
    ledger.write_batch(windows(spark, ("10:01", "10:02", 5.0, 1)), 1, root)
    before = ledger.live_table(spark, root, REGION).collect()
    ledger.write_batch(windows(spark, ("10:01", "10:02", 5.0, 1)), 1, root)
    assert ledger.live_table(spark, root, REGION).collect() == before
    assert before[0].revenue == 15.0


def test_update_mode_keeps_the_last_value(spark):
    root = session.work_folder(spark, "update")
    ledger.write_batch(windows(spark, ("10:00", "10:01", 10.0, 1)), 0, root)
    ledger.write_batch(windows(spark, ("10:00", "10:01", 25.0, 3)), 1, root)
    row = ledger.live_table(spark, root, REGION).first()
    assert (row.revenue, row.salesCount) == (25.0, 3)


def test_averages_are_weighted(spark):
    rows = windows(spark, ("10:00", "10:01", 100.0, 1), ("10:01", "10:02", 60.0, 3))
    row = ledger.merge_additive(rows, ["region", "sector"], ["revenue", "salesCount"]).first()
    assert row.revenue / row.salesCount == 40


def test_compaction_keeps_the_table(spark):
    root = session.work_folder(spark, "compact")
    ledger.write_batch(windows(spark, ("10:00", "10:01", 10.0, 1), ("10:01", "10:02", 1.0, 1)), 0, root)
    ledger.write_batch(windows(spark, ("10:00", "10:01", 25.0, 3), ("10:02", "10:03", 2.0, 1)), 1, root)
    ledger.compact(spark, root, REGION, 1, "2024-01-01 10:01:00")
    assert ledger.live_table(spark, root, REGION).first().revenue == 28.0
    ledger.write_batch(windows(spark, ("10:02", "10:03", 7.0, 2)), 2, root)  # an open window moves on
    assert ledger.live_table(spark, root, REGION).first().revenue == 33.0
    ledger.compact(spark, root, REGION, 2, "2024-01-01 10:03:00")
    row = ledger.live_table(spark, root, REGION).first()
    assert (row.revenue, row.salesCount) == (33.0, 6)
    assert ledger.read_ledger(spark, root).count() == 1
    assert ledger.live_table(spark, root, REGION, ["sector"]).first().region == "r"


def test_first_run_of_market_products(spark):
    items = spark.createDataFrame([("p", "a", "s", 4, 10.0, "b"), ("p", "c", "s", 1, 5.0, "b")],
                                  "productId string, companyId string, sector string, quantity int, subtotal double, brand string")
    row = tables.market_top_products(tables.company_top_products(items, None)).first()
    assert (row.totalRevenue, row.totalQuantity, row.avgPrice, row.brand) == (15.0, 5, 3.0, "b")


def test_two_streams_keep_all_result_tables(spark):
    """One stream for each source; the kept tables equal the tables computed from the facts."""
    b = Tables(spark, FOLDER)
    root = session.work_folder(spark, "all")
    streams = runner.start_kept(inputs(b, False), root, True, ["sales"], watermark="2 hours", parts=2)
    streams += runner.start_kept(closed_inputs(b), root, True, ["items"], watermark="2 hours", parts=2)
    for q in streams:
        q.awaitTermination()
        assert q.exception() is None
    assert len(streams) == 2
    assert not streams[0].lastProgress["stateOperators"]  # sums need no state
    kept = runner.result_tables(spark, root, b.products, b.employees)
    own = tables.company_analytics(b.ev_sales)
    branded = tables.branded_items(b.ev_items, b.ev_sales, b.products)
    people = tables.company_employees(b.ev_sales, b.employees)
    products = tables.company_top_products(b.ev_items, b.products)
    expected = {
        "market_top_brands": tables.market_top_brands(tables.company_brands_all(branded), branded),
        "company_brands": tables.company_brands(tables.company_brands_all(branded)),
        "company_top_products": products, "market_top_products": tables.market_top_products(products),
        "sales_by_region": tables.sales_by_region(b.ev_sales),
        "company_employees": people, "market_employee_performance": tables.market_employee_performance(people),
    }
    assert len(kept) == 10
    for name, df in {**expected, "company_analytics": own}.items():
        got = {tuple(round(v, 6) if isinstance(v, float) else v for v in r)
               for r in kept[name]().select(*df.columns).collect()}
        want = {tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()}
        assert got == want, name


def test_default_windows_and_market_members(spark):
    rows = spark.createDataFrame([sale(1, "10:00:05"), sale(2, "10:00:25", company="d"), sale(3, "10:00:31")], SALES)
    assert windowed.sector_windows(rows).count() == 2 and windowed.company_windows(rows).count() == 2
    market = windowed.market_windows(rows).first()
    assert (market.totalCompanies, market.marketSalesCount) == (2, 3)
    assert {r.companyId for r in windowed.market_members(rows).collect()} == {"c", "d"}


def test_approximate_distinct_is_close(spark):
    b = Tables(spark, "/root/testdata/sf0.01")
    wide = {"window": "60 days", "watermark": "1 day"}
    near = windowed.market_brand_windows(b.ev_items, b.products, **wide)
    exact = windowed.market_brand_windows(b.ev_items, b.products, exact=True, **wide).withColumnRenamed("productCount", "n")
    both = near.join(exact, ["window_start", "brand", "sector"])
    wrong = F.abs(F.col("productCount") - F.col("n")) > 1 + 0.15 * F.col("n")  # three standard deviations
    assert both.count() > 0 and both.filter(wrong).count() == 0


def test_dedup_stream_with_and_without_spread(spark):
    folder = session.work_folder(spark, "dedup")
    rows = [sale(i % 5, "10:00:00") for i in range(50)]
    spark.createDataFrame(rows, SALES).withColumn("offset", F.monotonically_increasing_id()).write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    hot = spark.createDataFrame([("1",), ("3",)], "saleId string")
    for spread in ({}, {"spread": F.col("offset"), "hot": hot}, {"spread": F.col("offset")}):
        root = session.work_folder(spark, "dedup")
        unique = dedup_events(spark.readStream.schema(schema).parquet(folder), ["saleId"], **spread)
        (unique.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).foreachBatch(lambda df, n: ledger.write_batch(df, n, root)).start().awaitTermination())
        assert spark.read.parquet(f"{root}/batches").count() == 5


def test_work_folder_lies_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.work_folder(spark, "x")
    assert folder != session.work_folder(spark, "x")
    assert folder.startswith(shared.rstrip("/") + "/x-" if shared else "/")


def test_salted_join_is_complete(spark):
    b = Tables(spark, FOLDER)
    hot = b.ev_sales.filter("saleId % 3 = 0").select("saleId")
    for how in ("inner", "left"):
        joined = windowed.join_items_sales(b.ev_items, b.ev_sales, hot=hot, how=how)
        plain = windowed.join_items_sales(b.ev_items, b.ev_sales, how=how)
        columns = ["saleId", "productId", "quantity", "companyId", "price"]
        assert sorted(joined.select(*columns).collect()) == sorted(plain.select(*columns).collect())
    whole = with_brand(b.ev_items).join(b.ev_sales.filter("saleStatus = 'completed'").select("saleId"), "saleId", "left_semi")
    assert windowed.join_items_sales(b.ev_items, b.ev_sales).count() == whole.count()


def test_only_hot_sales_are_salted(spark):
    """Half of the lines under one sale: they spread over the tasks, and every other sale is one row of state."""
    time = dt.datetime.fromisoformat("2024-01-01 10:00:00")
    sales = [(str(i), time, 1.0, "c", "r", "s", "completed", "e") for i in range(2000)]
    lines = [("7" if i % 2 else str(i % 2000), f"p{i}", i % 9 + 1, 1.0, 1.0, "s", "c", time, "x") for i in range(8000)]
    ddl = "saleId string, productId string, quantity int, price double, subtotal double, sector string, companyId string, saleTime timestamp, brand string"
    folder = session.work_folder(spark, "hot")
    spark.createDataFrame(sales, SALES).write.parquet(f"{folder}/sales")
    items = spark.createDataFrame(lines, ddl)
    items.write.parquet(f"{folder}/items")
    hot = sketch.heavy_hitters(items, "saleId", 50).select("saleId")
    assert [r.saleId for r in hot.collect()] == ["7"]
    dealt = windowed.salted(items, "saleId", hot, F.xxhash64("productId", "quantity", "price"), "salt").repartition(8, "saleId", "salt")
    sizes = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]

    root = session.work_folder(spark, "hot")
    joined = windowed.join_items_sales(spark.readStream.schema(ddl).parquet(f"{folder}/items"),
                                       spark.readStream.schema(SALES).parquet(f"{folder}/sales"), hot=hot)
    query = (joined.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
             .trigger(availableNow=True).foreachBatch(lambda df, n: ledger.write_batch(df, n, root)).start())
    query.awaitTermination()
    assert spark.read.parquet(f"{root}/batches").count() == 8000
    state = query.recentProgress[0]["stateOperators"][0]["numRowsUpdated"]
    assert state == 8000 + 1999 + windowed.SALTS
