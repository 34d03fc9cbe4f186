"""Event messages: decoding with fixed schemas, encoding, and per-topic counts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topic, event type and key columns (the first one set is used) of each kind of event.
KINDS: dict[str, tuple[str, str, Sequence[str]]] = {
    "sale": ("sales", "sale.created", ("companyId", "_id")),
    "sale_item": ("sale_items", "sale_item.created", ("saleId", "_id")),
    "product": ("products", "product.created", ("companyId", "_id")),
    "client": ("clients", "client.created", ("companyId", "_id")),
    "employee": ("employees", "employee.created", ("companyId", "_id")),
    "payment": ("payments", "payment.created", ("saleId", "_id")),
    "analytics": ("analytics", "analytics.updated", ("companyId",)),
}
ANALYTICS_KEY = "analytics"


def decode(messages: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of JSON messages; a malformed message gives a row of nulls.

    The broker's timestamp stays as ``kafka_timestamp``; ``keep`` names further message columns.
    """
    data = F.from_json(F.col("value").cast("string"), schema).alias("data")
    broker = [F.col("timestamp").alias("kafka_timestamp")] if "timestamp" in messages.columns else []
    return messages.select(data, *broker, *keep).select(
        "data.*", *[c for c in ("kafka_timestamp",) if broker], *keep)


def to_events(df: DataFrame, kind: str, at: Any = None) -> DataFrame:
    """Rows as (topic, key, value) messages; ``at`` is the sending time, now by default."""
    topic, event_type, key_columns = KINDS[kind]
    moment = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    keys: list[Column] = [F.col(c).cast("string") for c in key_columns if c in df.columns]
    if kind == "analytics":
        keys.append(F.lit(ANALYTICS_KEY))
    body = F.struct("*", F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
                    F.lit(event_type).alias("eventType"))
    return df.drop("timestamp", "eventType").select(
        F.lit(topic).alias("topic"), F.coalesce(*keys).alias("key"), F.to_json(body).alias("value"))


def write_events(events: DataFrame, target: dict[str, str]) -> None:
    """Send messages to Kafka (options given) or append them to a Parquet folder (``path``)."""
    if "path" in target:
        events.write.mode("append").partitionBy("topic").parquet(target["path"])
    else:
        events.write.format("kafka").options(**target).save()


def topic_stats(events: DataFrame, id_of: Column | None = None) -> DataFrame:
    """Per topic: messages consumed, duplicates of an id within a topic partition, and undecodable ones.

    Counting per id first keeps a hot id from reaching one task row by row.
    """
    ids = F.get_json_object("value", "$._id") if id_of is None else id_of
    partition = F.col("partition") if "partition" in events.columns else F.lit(0)
    # a valid message without a known field is no error: only what cannot be decoded is
    shape = T.StructType([T.StructField("eventType", T.StringType()), T.StructField("_bad", T.StringType())])
    read = F.from_json("value", shape, {"columnNameOfCorruptRecord": "_bad"})
    bad = read.isNull() | read["_bad"].isNotNull()
    per_id = events.groupBy("topic", partition.alias("part"), ids.alias("id"), bad.alias("bad")).agg(
        F.count("*").alias("n"))
    return per_id.groupBy("topic").agg(
        F.sum("n").alias("consumed"),
        F.sum(F.when(~F.col("bad") & F.col("id").isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicates"),
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("errors"))
