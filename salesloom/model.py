"""Schemas, value domains and keys of the sales data model."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _TS, _I, _B = T.StringType(), T.DoubleType(), T.TimestampType(), T.IntegerType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Event messages. Every field is nullable; unknown JSON keys are dropped by the decoder.
SALE_EVENT = _struct(
    ("_id", _S), ("saleTime", _TS), ("totalAmount", _D), ("companyId", _S), ("branchId", _S),
    ("region", _S), ("city", _S), ("sector", _S), ("saleType", _S), ("saleStatus", _S),
    ("employeeId", _S), ("clientId", _S), ("timestamp", _S), ("eventType", _S))

ITEM_EVENT = _struct(
    ("_id", _S), ("saleId", _S), ("productId", _S), ("quantity", _I), ("price", _D), ("subtotal", _D),
    ("sector", _S), ("companyId", _S), ("saleTime", _TS), ("brand", _S), ("timestamp", _S),
    ("eventType", _S))

# The remaining topics are counted and de-duplicated only, which needs these fields.
ENTITY_EVENT = _struct(("_id", _S), ("companyId", _S), ("saleId", _S), ("timestamp", _S), ("eventType", _S))

EVENT_SCHEMAS = {
    "sales": SALE_EVENT, "sale_items": ITEM_EVENT, "products": ENTITY_EVENT, "clients": ENTITY_EVENT,
    "employees": ENTITY_EVENT, "payments": ENTITY_EVENT, "analytics": ENTITY_EVENT,
}

# Dimensions as the enrichment joins need them.
PRODUCT_DIM = _struct(("productId", _S), ("productName", _S), ("brand", _S), ("productPrice", _D),
                      ("categoryId", _S))
EMPLOYEE_DIM = _struct(("employeeId", _S), ("employeeName", _S), ("companyId", _S), ("position", _S))

# Nested sale documents as they arrive at ingestion.
SALE_DOCUMENT = T.StructType(
    [T.StructField("saleId", _S)]
    + [f for f in SALE_EVENT.fields if f.name not in ("_id", "timestamp", "eventType")]
    + [T.StructField("source", _S),
       T.StructField("items", T.ArrayType(_struct(
           ("productId", _S), ("quantity", _I), ("price", _D), ("discount", _D), ("subtotal", _D),
           ("brand", _S), ("categoryId", _S))))])

# Domains, defaults and limits of the data model.
SALE_STATUSES = ["pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "completed"]
SALE_TYPES = ["retail", "wholesale", "online", "pharmacy", "distribution", "other"]
SECTORS = ["pharmacy", "mall", "distribution", "other"]
PAYMENT_TYPES = ["cash", "cheque", "card", "bank_transfer", "other"]
PAYMENT_STATUSES = ["pending", "completed", "failed", "refunded"]

# Keys of the maintained result tables.
RESULT_KEYS = {
    "market_top_products": ["sector", "productId"],
    "market_top_brands": ["sector", "brand"],
    "market_employee_performance": ["sector"],
    "company_analytics": ["companyId", "sector"],
    "market_analytics": ["sector"],
    "company_brands": ["companyId", "sector", "brand"],
    "company_employees": ["companyId", "employeeId"],
    "company_top_products": ["companyId", "sector", "productId"],
    "sales_by_sector": ["sector"],
    "sales_by_region": ["region", "sector"],
}

# Stored facts are partitioned by the day of their time; a time range then skips the other days' files.
DAY = "saleDay"
