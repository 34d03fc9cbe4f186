"""Top-k, top-k per group and pages, all with a total order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by(*columns: str) -> list[Column]:
    """Sort columns; a leading minus means descending."""
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in columns]


def top(df: DataFrame, order: Sequence[str], k: int | None = None) -> DataFrame:
    """Sorted rows, or the first k: each task keeps k rows and only those are merged."""
    df = df.orderBy(*by(*order))
    return df if k is None else df.limit(k)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int,
                  rank: str = "rank") -> DataFrame:
    """First k rows of each group, with their rank.

    Spark limits each group to k rows before the shuffle (WindowGroupLimit), so a hot group sends
    at most k rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*by(*order))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def page(df: DataFrame, order: Sequence[str], number: int = 1, size: int = 50) -> DataFrame:
    """A page by its number, for the first pages: every task keeps all earlier rows too. See ``page_after``."""
    return df.orderBy(*by(*order)).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, order: Sequence[str], last: Mapping[str, object] | None = None,
               size: int = 50) -> DataFrame:
    """The rows behind ``last``, the sort columns of the row before: any page costs what the first one costs.

    ``order`` must be total. Nulls come first where ascending and last where descending, as in a sort.
    """
    if last is not None:
        behind, equal = F.lit(False), F.lit(True)
        for c in order:
            name, value = c.lstrip("-"), last[c.lstrip("-")]
            if c.startswith("-"):
                beyond = F.lit(False) if value is None else F.col(name).isNull() | (F.col(name) < F.lit(value))
            else:
                beyond = F.col(name).isNotNull() if value is None else F.col(name) > F.lit(value)
            behind, equal = behind | (equal & beyond), equal & F.col(name).eqNullSafe(F.lit(value))
        df = df.filter(behind)
    return top(df, order, size)


def page_info(df: DataFrame, number: int = 1, size: int = 50) -> DataFrame:
    """Total rows and pages of a listing."""
    return df.agg(F.count("*").alias("total")).select(
        "total", F.ceil(F.col("total") / size).alias("totalPages"), F.lit(number).alias("currentPage"))
