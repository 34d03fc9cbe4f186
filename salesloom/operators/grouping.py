"""Grouping with descriptive text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.measures import total


def group_with_texts(df: DataFrame, keys: Sequence[str], texts: Sequence[str],
                     sums: Mapping[str, Column], plain: Sequence[str] = ()) -> DataFrame:
    """Additive measures per key, with the least value of each text column.

    Doubles are money and added up to four decimals, but for those named ``plain``, which keep all digits.

    A minimum of strings would make Spark sort all rows before it can combine them. So the texts, which
    hardly vary within a key, join the keys of a first hash aggregation over the rows, and only its
    small result is reduced to the keys. A stream cannot group twice in update mode and takes the
    direct way over its micro-batch.
    """
    aggregates = [c.alias(name) for name, c in sums.items()]
    lowest = [F.min(c).alias(c) for c in texts]
    if df.isStreaming:
        return df.groupBy(*keys).agg(*aggregates, *lowest)
    first = df.groupBy(*keys, *texts).agg(*aggregates)
    kinds = dict(first.dtypes)
    again = [(total(name) if kinds[name] == "double" and name not in plain else F.sum(name)).alias(name)
             for name in sums]
    return first.groupBy(*keys).agg(*again, *lowest)
