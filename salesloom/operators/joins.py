"""Joins between facts and dimensions.

No join carries a broadcast hint: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting skewed partitions at run
time. Where a dimension only names a group, the plans aggregate first and join the groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import model
from salesloom.functions import names


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], columns: Sequence[str],
           how: str = "left") -> DataFrame:
    """Attach chosen columns of a keyed table."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(dim.select(*keys, *columns), keys, how)


def _key_types(df: DataFrame, dim: DataFrame | None, schema, key: str) -> DataFrame:
    """The dimension, or a typed empty one with the same key type as the facts."""
    if dim is not None:
        return dim
    empty = df.sparkSession.createDataFrame([], schema)
    return empty.withColumn(key, F.col(key).cast(df.schema[key].dataType))


def enrich_items(items: DataFrame, products: DataFrame | None) -> DataFrame:
    """Items with product name, price and brand; the product's brand wins over the item's.

    A missing dimension is an empty one: names are null and the brand is the item's.
    """
    products = _key_types(items, products, model.PRODUCT_DIM, "productId")
    dim = products.select("productId", "productName", "productPrice", F.col("brand").alias("dimBrand"))
    return (items.join(dim, "productId", "left")
            .withColumn("brand", F.coalesce("dimBrand", "brand")).drop("dimBrand"))


def enrich_sales(sales: DataFrame, employees: DataFrame | None) -> DataFrame:
    employees = _key_types(sales, employees, model.EMPLOYEE_DIM, "employeeId")
    return lookup(sales, employees, "employeeId", ["employeeName", "position"])


def items_with_sale(items: DataFrame, sales: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Items of existing sales, with sale columns; an item's own copy of a column gives way."""
    return items.drop(*columns).join(sales.select("saleId", *columns), "saleId")


def items_with_product(items: DataFrame, products: DataFrame, columns: Sequence[str],
                       how: str = "inner") -> DataFrame:
    return lookup(items.drop(*columns), products, "productId", columns, how)


def items_with_category(items: DataFrame, categories: DataFrame) -> DataFrame:
    return lookup(items, categories, "categoryId", ["categoryName"])


def items_of_matching_sales(items: DataFrame, sales: DataFrame) -> DataFrame:
    """Items whose sale is among ``sales``; nothing of the sale is carried along."""
    return items.join(sales.select("saleId"), "saleId", "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent does not exist.

    Both sides reach the join straight from their shuffles, so a hot key of the children is split at run time.
    """
    return child.join(parent.select(key), key, "left_anti")


def sales_with_items(sales: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Sale header repeated on each of its lines, with product columns; a sale without lines stays once.

    Lines stay rows: an array per sale would gather a hot sale in one task. An outer join cannot split
    the lines of a hot sale either, so it is written as an inner join and the sales without lines.
    """
    lines = lookup(items.drop("brand"), products, "productId", ["productName", "brand"])
    matched = sales.join(lines.withColumnRenamed("brand", "productBrand"), "saleId")
    return matched.unionByName(orphans(sales, items, "saleId"), allowMissingColumns=True)


def name_employees(df: DataFrame, employees: DataFrame | None, *stored: str) -> DataFrame:
    """employeeName by the chain: stored names, employee of this company, employee by id, made-up name.

    One lookup by id serves both dimension steps, because ids are unique: the company only decides
    which of two equal answers is taken.
    """
    employees = _key_types(df, employees, model.EMPLOYEE_DIM, "employeeId")
    dim = employees.select("employeeId", F.col("employeeName").alias("dimName"))
    resolved = names.resolve_employee_name(F.col("employeeId"), *[F.col(c) for c in stored], F.col("dimName"))
    return df.join(dim, "employeeId", "left").withColumn("employeeName", resolved).drop("dimName")


def name_products(df: DataFrame, products: DataFrame | None, *stored: str) -> DataFrame:
    """productName and brand by the chain: stored values, then the product dimension."""
    products = _key_types(df, products, model.PRODUCT_DIM, "productId")
    dim = products.select("productId", F.col("productName").alias("dimName"), F.col("brand").alias("dimBrand"))
    joined = df.join(dim, "productId", "left")
    name = names.resolve_product_name(*[F.col(c) for c in stored], F.col("dimName"))
    brand: Column = F.coalesce("dimBrand", "brand") if "brand" in df.columns else F.col("dimBrand")
    return joined.withColumn("productName", name).withColumn("brand", brand).drop("dimName", "dimBrand")
