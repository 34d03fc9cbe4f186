"""Items joined with their sales inside the micro-batches.

A stream join puts every row of both sides into its state, also those that meet in the same batch. Here a batch is joined
like any two tables, with the recent rows of earlier batches, and only rows that may still meet later ones are stored:
they lie behind neither side's latest time by more than the delay and the bound. So a batch of any size needs no more
memory than a shuffle, and what is stored follows from the delay.

Batch N starts from the newest finished generation before N, so a replay gives the same rows.

Folder layout: <root>/recent/gen=N; Spark's _SUCCESS file marks a finished generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.operators.filters import completed
from salesloom.streaming.kept import GENERATIONS, finished, remove
from salesloom.streaming.windowed import TWO_MINUTES, join_items_sales


def items_and_sales(items: DataFrame, sales: DataFrame) -> DataFrame:
    """Both streams as one: a row has an ``item`` or a completed ``sale``."""
    sales = completed(sales).select("saleId", "saleTime", "companyId", "saleStatus")
    sides = {name: df.withColumn("saleTime", F.col("saleTime").cast("timestamp"))
             for name, df in (("item", items), ("sale", sales))}

    def rows(own: str) -> DataFrame:
        return sides[own].select(*[(F.struct(*df.columns) if name == own else F.lit(None).cast(df.schema)).alias(name)
                                   for name, df in sides.items()])

    return rows("item").unionByName(rows("sale"))


def _recent(spark: SparkSession, root: str, batch: DataFrame, batch_id: int) -> DataFrame:
    before = [n for n in finished(spark, f"{root}/recent") if n < batch_id]
    if not before:
        return spark.createDataFrame([], batch.schema)
    return spark.read.schema(batch.schema).parquet(f"{root}/recent/gen={max(before)}")


def _passed(rows: DataFrame, watermark: str) -> tuple[Column | None, Column | None]:
    """The time that both sides have passed, before the batch and with it; None while a side has no row."""
    def latest(only: Column) -> Column:
        ends = [F.max(F.when(only, F.col(side)["saleTime"])) for side in ("item", "sale")]
        both = ends[0].isNotNull() & ends[1].isNotNull()
        return F.unix_micros(F.when(both, F.least(*ends)) - F.expr(f"INTERVAL {watermark}"))

    found = rows.agg(latest(~F.col("isNew")), latest(F.lit(True))).first()
    before, now = (None if micros is None else F.timestamp_micros(F.lit(micros)) for micros in found)
    return before, now


def items_with_company(batch: DataFrame, batch_id: int, root: str, bound: str = TWO_MINUTES,
                       watermark: str = TWO_MINUTES, hot: DataFrame | None = None) -> DataFrame:
    """Every item once, with ``headCompany`` of its completed sale; without one, as soon as none can come any more.

    Sale ids are unique (see ``dedup_events``). Rows behind the time that both sides had passed before are too late.
    The batch is read anew for its latest times, for the rows to store and for each side of the join: its columns are cheaper
    to make again than to keep, however long it is.
    """
    spark = batch.sparkSession
    rows = _recent(spark, root, batch, batch_id).withColumn("isNew", F.lit(False)).unionByName(
        batch.withColumn("isNew", F.lit(True)))
    before, now = _passed(rows, watermark)
    reach, time = F.expr(f"INTERVAL {bound}"), F.coalesce(F.col("item")["saleTime"], F.col("sale")["saleTime"])
    if before is not None:
        rows = rows.filter(~F.col("isNew") | (time > before))

    # a line is stored until no sale can come any more, a sale for as long as its lines are
    stored = rows.drop("isNew")
    if now is not None:
        stored = stored.filter(time > F.when(F.col("item").isNotNull(), now - reach).otherwise(now - reach - reach))
    stored.hint("rebalance").write.mode("overwrite").parquet(f"{root}/recent/gen={batch_id}")
    for n in sorted(finished(spark, f"{root}/recent"))[:-GENERATIONS]:
        remove(spark, f"{root}/recent/gen={n}")

    lines = rows.filter("item IS NOT NULL").select("item.*", "isNew")
    heads = rows.filter("sale IS NOT NULL").select("sale.*", F.col("isNew").alias("headIsNew"))
    joined = join_items_sales(lines, heads, bound, watermark, hot, "left", ["headIsNew"])
    out = F.col("headIsNew") | (F.col("headIsNew").isNotNull() & F.col("isNew"))
    if now is not None:
        out = out | (F.col("headIsNew").isNull() & (F.col("saleTime") <= now - reach))
    return joined.filter(out).drop("isNew", "headIsNew")
