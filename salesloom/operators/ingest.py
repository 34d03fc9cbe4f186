"""Set-wise ingestion of nested sale documents and payments."""

from __future__ import annotations

import dataclasses
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salesloom.functions.measures import MONEY, total
from salesloom.operators.joins import lookup
from salesloom.operators.validate import RULES, accepted, rejected, validate
from salesloom.session import work_folder
from salesloom.sources.events import to_events, write_events


def line_subtotal(quantity: Column, price: Column, discount: Column) -> Column:
    """quantity x price less the discount (none counts as 0)."""
    exact = quantity.cast("decimal(18,0)") * price.cast("decimal(12,4)") - F.coalesce(
        discount.cast("decimal(12,4)"), F.lit(0).cast("decimal(12,4)"))
    return exact.cast(MONEY)


def _item_subtotal(item: Column) -> Column:
    return F.coalesce(item["subtotal"].cast(MONEY), line_subtotal(item["quantity"], item["price"], item["discount"]))


def document_total(items: Column) -> Column:
    """Sum of a document's own lines, 0 without lines: computed inside the row, without a shuffle."""
    zero = F.lit(0).cast("decimal(28,4)")
    lines = F.coalesce(F.transform(items, _item_subtotal), F.array().cast(f"array<{MONEY}>"))
    return F.aggregate(lines, zero, lambda s, x: (s + F.coalesce(x, F.lit(0).cast(MONEY))).cast("decimal(28,4)"))


def split_sales(docs: DataFrame, now: Any = None) -> tuple[DataFrame, DataFrame]:
    """Sales without items, and items carrying the sale's id, sector, company and time."""
    moment = F.current_timestamp() if now is None else F.lit(now)
    kind = docs.schema["saleTime"].dataType
    docs = docs.withColumn("saleTime", F.coalesce("saleTime", moment.cast(kind)))
    sales = docs.withColumn("totalAmount", document_total(F.col("items")).cast("double")).drop("items")
    items = docs.select("saleId", "sector", "companyId", "saleTime", F.explode("items").alias("i")).select(
        "saleId", "sector", "companyId", "saleTime", F.col("i.productId"), F.col("i.quantity"), F.col("i.price"),
        F.col("i.discount"), F.col("i.brand"), F.col("i.categoryId"), _item_subtotal(F.col("i")).alias("subtotal"))
    return sales, items


def fill_brand(items: DataFrame, products: DataFrame) -> DataFrame:
    """The item's brand, else its product's."""
    dim = products.select("productId", F.col("brand").alias("dimBrand"))
    return (lookup(items, dim, "productId", ["dimBrand"])
            .withColumn("brand", F.coalesce("brand", "dimBrand")).drop("dimBrand"))


def recompute_totals(sales: DataFrame, items: DataFrame) -> DataFrame:
    """totalAmount from the stored items, 0 for a sale without items."""
    sums = items.groupBy("saleId").agg(total("subtotal").alias("itemTotal"))
    return (sales.join(sums, "saleId", "left")
            .withColumn("totalAmount", F.coalesce("itemTotal", F.lit(0.0))).drop("itemTotal"))


def check_batch(docs: DataFrame, source: str | None = None, company_id: str | None = None,
                branch_id: str | None = None, now: Any = None) -> DataFrame:
    """Documents with normalised values, their total and the list of what is wrong with each (``errors``).

    A bad line rejects its document. Overrides replace the document's own values.
    """
    overrides = {"source": source, "companyId": company_id, "branchId": branch_id}
    for name, value in overrides.items():
        if value is not None:
            docs = docs.withColumn(name, F.lit(value))
    if now is not None:
        docs = docs.withColumn("saleTime", F.coalesce("saleTime", F.lit(now).cast(docs.schema["saleTime"].dataType)))
    checked = validate(docs, "sales")
    line_checks = {
        "productId is required": lambda i: i["productId"].isNull(),
        "quantity is required": lambda i: i["quantity"].isNull(),
        "quantity is less than 1": lambda i: i["quantity"] < 1,
        "price is required": lambda i: i["price"].isNull(),
        "price is less than 0": lambda i: i["price"] < 0,
        "subtotal is less than 0": lambda i: _item_subtotal(i) < 0,
    }
    lines = [F.when(F.exists("items", check), reason) for reason, check in line_checks.items()]
    checked = checked.withColumn("errors", F.concat("errors", F.array_compact(F.array(*lines))))
    return checked.withColumn("totalAmount", document_total(F.col("items")).cast("double"))


@dataclasses.dataclass(frozen=True)
class Ingested:
    """What became of a batch of documents, as it is stored, and the number of each kind."""

    accepted: DataFrame
    rejected: DataFrame
    report: dict[str, int]


def ingest_batch(docs: DataFrame, folder: str | None = None, **options: Any) -> Ingested:
    """Check a batch once: one write deals the documents out by outcome while they are counted.

    ``options`` are those of ``check_batch``. The stored documents are what later steps read, so no rule runs again.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "ingested")
    checked = check_batch(docs, **options)
    outcome = F.when(F.size("errors") > 0, "rejected").otherwise("accepted")
    counts = Observation()
    dealt = checked.withColumn("outcome", outcome).observe(
        counts, F.count(F.lit(1)).alias("total"), F.count_if(F.col("outcome") == "accepted").alias("success"),
        F.count_if(F.col("outcome") == "rejected").alias("failed"))
    dealt.write.mode("overwrite").partitionBy("outcome").parquet(folder)
    stored = spark.read.schema(dealt.schema).parquet(folder)
    return Ingested(accepted(stored.filter("outcome = 'accepted'").drop("outcome")),
                    rejected(stored.filter("outcome = 'rejected'").drop("outcome")), dict(counts.get))


def sale_messages(docs: DataFrame, products: DataFrame, now: Any = None, at: Any = None) -> DataFrame:
    """The messages of accepted documents: each sale with its lines, and each line with its sale's keys and time."""
    sales, items = split_sales(docs, now)
    items = fill_brand(items, products)
    whole = sales.join(docs.select("saleId", "items"), "saleId").withColumnRenamed("saleId", "_id")
    return to_events(whole, "sale", at).unionByName(to_events(items, "sale_item", at))


def ingest_sales(docs: DataFrame, products: DataFrame, target: dict[str, str], now: Any = None, at: Any = None,
                 **options: Any) -> Ingested:
    """From documents to messages: check, store by outcome, split, fill brands, add up and send what was accepted."""
    done = ingest_batch(docs, now=now, **options)
    write_events(sale_messages(done.accepted, products, now, at), target)
    return done


def ingest_payments(payments: DataFrame, now: Any = None) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected payments; saleId is required, the date defaults to now."""
    if "paymentDate" in payments.columns:
        kind = payments.schema["paymentDate"].dataType
        moment = F.current_timestamp() if now is None else F.lit(now)
        payments = payments.withColumn("paymentDate", F.coalesce("paymentDate", moment.cast(kind)))
    checked = validate(payments, RULES["payments"])
    return accepted(checked), rejected(checked)
