"""Event streams from Kafka or from files, behind one switch."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesloom import model
from salesloom.sources.events import decode


@dataclasses.dataclass(frozen=True)
class StreamSource:
    """Where a stream comes from.

    format "kafka": options hold kafka.bootstrap.servers and more; messages are JSON.
    Any file format: options hold path and reader options; rows have the event schema.
    """

    format: str = "kafka"
    options: Mapping[str, str] = dataclasses.field(default_factory=dict)

    def read(self, spark: SparkSession, topic: str, schema: T.StructType) -> DataFrame:
        if self.format == "kafka":
            messages = (spark.readStream.format("kafka").option("subscribe", topic)
                        .option("startingOffsets", "latest").options(**self.options).load())
            return decode(messages, schema)
        return spark.readStream.format(self.format).schema(schema).options(**self.options).load()


def sales_stream(spark: SparkSession, source: StreamSource) -> DataFrame:
    return source.read(spark, "sales", model.SALE_EVENT).withColumnRenamed("_id", "saleId")


def items_stream(spark: SparkSession, source: StreamSource) -> DataFrame:
    return source.read(spark, "sale_items", model.ITEM_EVENT)


def entity_stream(spark: SparkSession, source: StreamSource, topic: str) -> DataFrame:
    return source.read(spark, topic, model.EVENT_SCHEMAS[topic])
