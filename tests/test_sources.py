"""Dimensions, bucketed facts, events and stamps."""

import pytest
from pyspark.sql import functions as F

from salesloom import model, session
from salesloom.catalog.bindings import Tables
from salesloom.operators.joins import items_with_sale
from salesloom.sources import events, streams
from salesloom.sources import tables as stored
from salesloom.streaming import runner

FOLDER = "/root/testdata/sf0.001"


def test_dimensions_have_text_ids(spark):
    b, path = Tables(spark, FOLDER), session.work_folder(spark, "dim")
    b.products.withColumnRenamed("productId", "_id").write.parquet(path)
    products = stored.load_products(spark, path)
    assert products.schema["productId"].dataType.typeName() == "string"
    assert products.columns == ["productId", "productName", "brand", "productPrice", "categoryId"]
    path = session.work_folder(spark, "dim")
    b.employees.write.parquet(path)
    assert stored.load_employees(spark, path).count() == b.employees.count()


def test_bucketed_facts_join_without_a_shuffle(spark):
    b, path = Tables(spark, FOLDER), session.work_folder(spark, "facts")
    try:
        for name, df in (("facts_sales", b.sales), ("facts_items", b.items)):
            stored.save_facts(df, name, 4, path=f"{path}/{name}")
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = items_with_sale(spark.table("facts_items"), spark.table("facts_sales"), ["companyId"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == items_with_sale(b.items, b.sales, ["companyId"]).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("facts_sales", "facts_items"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_event_round_trip_and_malformed_messages(spark):
    b, path = Tables(spark, FOLDER), session.work_folder(spark, "events")
    sent = events.to_events(b.ev_sales.withColumnRenamed("saleId", "_id"), "sale")
    events.write_events(sent, {"path": path})
    read = events.decode(spark.read.parquet(path), model.SALE_EVENT)
    assert read.filter("eventType = 'sale.created' AND companyId IS NOT NULL").count() == b.ev_sales.count()
    broken = spark.createDataFrame([("{oops",), ('{"_id": "1", "unknown": 3}',)], "value string")
    rows = events.decode(broken, model.SALE_EVENT).collect()
    assert [r._id for r in rows] == [None, "1"] and "unknown" not in rows[0].asDict()


def test_broker_time_is_kept(spark):
    message = spark.createDataFrame([("{}",)], "value string").withColumn("timestamp", F.current_timestamp())
    assert "kafka_timestamp" in events.decode(message, model.ITEM_EVENT).columns


def test_kafka_source_is_the_default():
    assert streams.StreamSource().format == "kafka"


def test_stamp(spark):
    row = runner.stamp(spark.range(1), 7).first()
    assert row.window == "batch_7" and row.updatedAt is not None


def test_no_shared_folder_is_an_error(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Remote:
        conf = Conf()

    with pytest.raises(ValueError):
        session.work_folder(Remote(), "x")
