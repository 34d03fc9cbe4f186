"""Paged listings. Rows are chosen first; names are attached to the chosen page only.

A page is asked for by its number, or as what follows a row (``after``: the sort columns of the last row seen, empty for the
first page). The latter costs the same for every page.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.filters import ALL, Filters, apply_filters, date_range, equal_to, filter_products
from salesloom.operators.joins import lookup
from salesloom.operators.topk import page, page_after, top

# The order of each listing.
SALES_ORDER = ["-saleTime", "saleId"]
ITEMS_ORDER = ["-saleId", "productId", "quantity", "subtotal"]
PAYMENTS_ORDER = ["-paymentDate", "saleId"]


def _page(rows: DataFrame, order: Sequence[str], number: int, size: int, after: Mapping[str, Any] | None) -> DataFrame:
    return page(rows, order, number, size) if after is None else page_after(rows, order, after or None, size)


def sales_list(sales: DataFrame, clients: DataFrame, employees: DataFrame, f: Filters = ALL,
               number: int = 1, size: int = 50, after: Mapping[str, Any] | None = None) -> DataFrame:
    rows = _page(apply_filters(sales, f), SALES_ORDER, number, size, after)
    return lookup(lookup(rows, clients, "clientId", ["clientName"]), employees, "employeeId", ["employeeName"])


def items_list(items: DataFrame, sales: DataFrame, products: DataFrame, categories: DataFrame,
               number: int = 1, size: int = 100, after: Mapping[str, Any] | None = None, **values: Any) -> DataFrame:
    """Optional equality on saleId, productId, categoryId, brand."""
    rows = _page(equal_to(items, **values), ITEMS_ORDER, number, size, after)
    rows = lookup(rows, sales, "saleId", ["saleTime", "saleStatus", "totalAmount"])
    named = products.select("productId", "productName", "productPrice", F.col("brand").alias("productBrand"))
    rows = lookup(rows, named, "productId", ["productName", "productPrice", "productBrand"])
    return lookup(rows, categories, "categoryId", ["categoryName"])


def products_list(products: DataFrame, categories: DataFrame, number: int = 1, size: int = 50,
                  after: Mapping[str, Any] | None = None, **conditions: Any) -> DataFrame:
    rows = _page(filter_products(products, **conditions), ["-productId"], number, size, after)
    return lookup(rows, categories, "categoryId", ["categoryName"])


def clients_list(clients: DataFrame, number: int = 1, size: int = 50, after: Mapping[str, Any] | None = None,
                 **values: Any) -> DataFrame:
    return _page(equal_to(clients, **values), ["-clientId"], number, size, after)


def employees_list(employees: DataFrame, number: int = 1, size: int = 50, after: Mapping[str, Any] | None = None,
                   **values: Any) -> DataFrame:
    return _page(equal_to(employees, **values), ["-employeeId"], number, size, after)


def payments_list(payments: DataFrame, sales: DataFrame, start: Any = None, end: Any = None, number: int = 1,
                  size: int = 50, after: Mapping[str, Any] | None = None, **values: Any) -> DataFrame:
    """Optional equality on saleId, companyId, branchId, paymentType, paymentStatus."""
    rows = _page(equal_to(date_range(payments, "paymentDate", start, end), **values), PAYMENTS_ORDER, number, size, after)
    return lookup(rows, sales, "saleId", ["saleTime", "totalAmount", "saleStatus"])


def products_of_brand(products: DataFrame, brand: str) -> DataFrame:
    return top(equal_to(products, brand=brand, isActive=True), ["productName", "productId"])


def clients_of_region(clients: DataFrame, region: str) -> DataFrame:
    return top(equal_to(clients, region=region), ["clientName", "clientId"])


def categories_by_name(categories: DataFrame) -> DataFrame:
    return top(categories, ["categoryName", "categoryId"])
