"""Money, averages and percentages.

Money is summed exactly, so a total does not depend on the order in which partitions are merged, and
every average is carried as (sum, count) until the end. Results are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
EXACT = "decimal(28,4)"  # sums that are stored or added up again


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _summed(c: str | Column) -> Column:
    """Exact sum of amounts with up to four decimals.

    Whole units and ten-thousandths are added as two BIGINTs, which stay in the generated code of the
    hash aggregation (a DECIMAL sum allocates an object per row), reach 9e18 and fail rather than wrap.
    """
    amount = _col(c).cast("double")
    whole = F.floor(amount)
    parts = F.sum(F.floor((amount - whole) * 10000 + 0.5)).cast("decimal(20,0)")
    return (F.sum(whole).cast("decimal(20,0)") * 10000 + parts) / 10000


def total(c: str | Column) -> Column:
    """Exact sum, as a double at the end."""
    return _summed(c).cast("double")


def exact_total(c: str | Column) -> Column:
    """Exact sum as DECIMAL(28,4), for tables that are stored or added up again."""
    return _summed(c).cast(EXACT)


def total_again(c: str | Column) -> Column:
    """Exact sum of amounts that are sums already: stored DECIMALs, or doubles with the digits they print."""
    return F.sum(_col(c).cast(EXACT)).cast(EXACT)


def mean(c: str | Column) -> Column:
    return F.try_divide(total(c), F.count(_col(c)))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def gap(value: Column, base: Column) -> Column:
    """Difference from a base in percent of the base, 0 where there is no base."""
    return F.when(base > 0, (value - base) / base * 100).otherwise(F.lit(0.0))


def or_zero(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def sales_measures() -> list[Column]:
    """Revenue, number and average of sales: the measures most questions share."""
    return [total("totalAmount").alias("totalRevenue"), F.count("*").alias("totalSales"),
            mean("totalAmount").alias("avgSaleAmount")]


# Null-safe reading of loosely typed stored fields.
def safe_string(c: str | Column) -> Column:
    return _col(c).cast("string")


def safe_double(c: str | Column) -> Column:
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def safe_long(c: str | Column) -> Column:
    return F.coalesce(_col(c).try_cast("bigint"), F.lit(0).cast("bigint"))
