"""Row selections shared by the plans."""

from __future__ import annotations

import dataclasses
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import model
from salesloom.functions import buckets


@dataclasses.dataclass(frozen=True)
class Filters:
    """Optional conditions; an unset one selects everything."""

    start: str | date | datetime | None = None
    end: str | date | datetime | None = None
    companyId: Any = None
    branchId: Any = None
    region: Any = None
    city: Any = None
    sector: Any = None
    clientId: Any = None
    employeeId: Any = None
    saleStatus: Any = None
    saleType: Any = None

    def equalities(self) -> dict[str, Any]:
        return {k: v for k, v in dataclasses.asdict(self).items()
                if k not in ("start", "end") and v is not None}


ALL = Filters()


def _moment(value: Any) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp_ntz")


def day_range(df: DataFrame, start: Any = None, end: Any = None) -> DataFrame:
    """The days that a time range touches, of facts stored by day; others stay as they are.

    The condition reaches the scan as a partition filter, also where the moment is a scalar subquery. Items of a range
    of sales are cut alike: they are stored under the day of their sale.
    """
    if model.DAY not in df.columns:
        return df
    if start is not None:
        df = df.filter(F.col(model.DAY) >= F.to_date(_moment(start)))
    if end is not None:
        df = df.filter(F.col(model.DAY) <= F.to_date(_moment(end)))
    return df


def date_range(df: DataFrame, time: str, start: Any = None, end: Any = None) -> DataFrame:
    """Inclusive on both sides."""
    if time == "saleTime":
        df = day_range(df, start, end)
    if start is not None:
        df = df.filter(F.col(time) >= _moment(start))
    if end is not None:
        df = df.filter(F.col(time) <= _moment(end))
    return df


def equal_to(df: DataFrame, **values: Any) -> DataFrame:
    for name, value in values.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def apply_filters(df: DataFrame, f: Filters = ALL, time: str = "saleTime") -> DataFrame:
    return equal_to(date_range(df, time, f.start, f.end), **f.equalities())


def completed(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("saleStatus") == "completed")


def with_sector(items: DataFrame) -> DataFrame:
    return items.filter(F.col("sector").isNotNull())


def with_brand(items: DataFrame) -> DataFrame:
    return items.filter(F.col("brand").isNotNull() & (F.col("brand") != ""))


def has_employee(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("employeeId").isNotNull())


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with all grouping keys set; applied before the aggregation, not after it."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def peers(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Everybody but this one."""
    return df.filter(F.col(column) != F.lit(value))


def filter_products(products: DataFrame, min_price: float | None = None, max_price: float | None = None,
                    is_active: bool | None = None, **values: Any) -> DataFrame:
    if min_price is not None:
        products = products.filter(F.col("productPrice") >= min_price)
    if max_price is not None:
        products = products.filter(F.col("productPrice") <= max_price)
    return equal_to(products, isActive=is_active, **values)


def newest(df: DataFrame, time: str = "saleTime") -> Column:
    """Latest time as a scalar subquery: parquet answers it from a one-column scan, of the last day if days are stored."""
    if time == "saleTime" and model.DAY in df.columns:
        df = df.filter(F.col(model.DAY) == df.agg(F.max(model.DAY)).scalar())
    return df.agg(F.max(time)).scalar()


def last_minutes(df: DataFrame, minutes: int, as_of: Any = None, time: str = "saleTime") -> DataFrame:
    """Rows of the last ``minutes`` before ``as_of``, which defaults to the newest row."""
    moment = newest(df, time) if as_of is None else _moment(as_of)
    return date_range(df, time, moment - F.expr(f"INTERVAL {int(minutes)} MINUTES"))


def lookback(df: DataFrame, period: str, as_of: Any = None, time: str = "saleTime") -> DataFrame:
    """Rows of the preset look-back (day, week, month, year) up to ``as_of``."""
    moment = newest(df, time) if as_of is None else _moment(as_of)
    return date_range(df, time, buckets.lookback_start(period, moment), moment)
