"""Validation of incoming rows: normalise, fill defaults, and list what is wrong with each row."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import model


@dataclasses.dataclass(frozen=True)
class Field:
    name: str
    required: bool = False
    choices: Sequence[str] | None = None
    default: Any = None
    minimum: float | None = None
    shortest: int | None = None
    longest: int | None = None
    trim: bool = False
    lower: bool = False

    def normal(self, c: Column) -> Column:
        if self.trim:
            c = F.trim(c)
        if self.lower:
            c = F.lower(c)
        if self.default is not None:
            c = F.coalesce(c, self.default if isinstance(self.default, Column) else F.lit(self.default))
        return c

    def reasons(self) -> list[Column]:
        c, found = F.col(self.name), []
        if self.required:
            missing = c.isNull() | (c.cast("string") == "")
            found.append(F.when(missing, f"{self.name} is required"))
        if self.choices is not None:
            found.append(F.when(~c.isin(*self.choices), f"{self.name} is not an allowed value"))
        if self.minimum is not None:
            found.append(F.when(c < self.minimum, f"{self.name} is less than {self.minimum:g}"))
        if self.shortest is not None:
            found.append(F.when(F.length(c) < self.shortest, f"{self.name} is shorter than {self.shortest}"))
        if self.longest is not None:
            found.append(F.when(F.length(c) > self.longest, f"{self.name} is longer than {self.longest}"))
        return found


def _texts(*names: str) -> list[Field]:
    return [Field(n, trim=True) for n in names]


# The constraints of each entity.
RULES: dict[str, list[Field]] = {
    "sales": [
        Field("saleStatus", choices=model.SALE_STATUSES, default="completed"),
        Field("totalAmount", default=0, minimum=0),
        Field("saleType", choices=model.SALE_TYPES, default="retail"),
        Field("sector", choices=model.SECTORS),
        Field("discountAmount", default=0, minimum=0), Field("taxAmount", default=0, minimum=0),
        *_texts("saleNotes", "companyId", "branchId", "region", "city", "source")],
    "sale_items": [
        Field("saleId", required=True), Field("productId", required=True),
        Field("quantity", required=True, minimum=1), Field("price", required=True, minimum=0),
        Field("subtotal", required=True, minimum=0), Field("discount", default=0, minimum=0),
        *_texts("itemNotes", "brand")],
    "products": [
        Field("productName", required=True, trim=True, longest=100),
        Field("productDescription", trim=True, longest=500), Field("productPrice", required=True, minimum=0),
        Field("stockQuantity", default=0, minimum=0), Field("unit", trim=True, default="piece"),
        Field("isActive", default=True), *_texts("brand", "sku", "barcode", "companyId", "supplierId")],
    "employees": [
        Field("employeeName", required=True, trim=True, longest=100),
        Field("employeeEmail", required=True, trim=True, lower=True),
        Field("employeePhone", required=True, trim=True), Field("isActive", default=True),
        *_texts("address", "department", "position", "companyId", "branchId")],
    "clients": [
        Field("clientName", required=True, trim=True, longest=100),
        Field("clientEmail", required=True, trim=True, lower=True), Field("clientPhone", required=True, trim=True),
        Field("clientLocation", required=True, trim=True),
        *_texts("region", "city", "companyId", "companyName", "branchId", "branchName")],
    "payments": [
        Field("saleId", required=True), Field("paymentAmount", required=True, minimum=0),
        Field("paymentType", required=True, choices=model.PAYMENT_TYPES),
        Field("paymentStatus", choices=model.PAYMENT_STATUSES, default="pending"),
        *_texts("transactionId", "notes", "chequeNumber", "bankName", "companyId", "branchId")],
    "categories": [
        Field("categoryName", required=True, trim=True, shortest=2, longest=50),
        Field("categoryDescription", trim=True, longest=200)],
}


def validate(df: DataFrame, rules: Sequence[Field] | str) -> DataFrame:
    """Normalised rows with an ``errors`` array, empty for a valid row.

    A column that is absent counts as null; it is added only where a default fills it.
    """
    rules = RULES[rules] if isinstance(rules, str) else rules
    present = {r.name: r.normal(F.col(r.name)) for r in rules if r.name in df.columns}
    added = {r.name: F.lit(r.default) for r in rules if r.name not in df.columns and r.default is not None}
    df = df.withColumns({**present, **added})
    reasons = [x for r in rules if r.name in df.columns for x in r.reasons()]
    absent = [F.lit(f"{r.name} is required") for r in rules if r.required and r.name not in df.columns]
    return df.withColumn("errors", F.array_compact(F.array(*reasons, *absent)).cast("array<string>"))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") == 0).drop("errors")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") > 0)
