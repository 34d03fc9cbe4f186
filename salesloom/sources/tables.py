"""Dimensions and fact tables at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _dimension(spark: SparkSession, path: str, key: str, columns: list[str]) -> DataFrame:
    df = spark.read.parquet(path)
    source = "_id" if "_id" in df.columns else key
    return df.select(F.col(source).cast("string").alias(key), *columns)


def load_products(spark: SparkSession, path: str) -> DataFrame:
    """Product dimension, id as text. Not cached: the scan reads five columns and is pruned further."""
    return _dimension(spark, path, "productId", ["productName", "brand", "productPrice", "categoryId"])


def load_employees(spark: SparkSession, path: str) -> DataFrame:
    return _dimension(spark, path, "employeeId", ["employeeName", "companyId", "position"])


def save_facts(df: DataFrame, table: str, buckets: int, key: str = "saleId", day: str | None = None,
               path: str | None = None, time: str = "saleTime") -> None:
    """Store facts bucketed by sale and sorted by time.

    Sales and items bucketed alike join on saleId without a shuffle. A day column as partition (made from ``time`` if
    it is not there, see ``model.DAY``) lets time ranges skip whole days, and within a day the sorting lets them skip
    row groups. The rows are brought to their buckets first, so each bucket is one file (per day) instead of one from
    every task.
    """
    if day and day not in df.columns:
        df = df.withColumn(day, F.to_date(time))
    sorting = [time, key] if time in df.columns else [key]
    writer = (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, key).sortBy(*sorting))
    if day:
        writer = writer.partitionBy(day)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
