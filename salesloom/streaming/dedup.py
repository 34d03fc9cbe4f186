"""Idempotent consumption: each message id counts once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.streaming.windowed import salted


def dedup_events(events: DataFrame, ids: Sequence[str], time: str = "saleTime", within: str = "2 minutes",
                 spread: Column | None = None, hot: DataFrame | None = None) -> DataFrame:
    """First message of each id.

    In batch, first means the least ``time``, then the least ``spread``, then the least row; copies are
    reduced in the map tasks before the shuffle. In a stream, where they would all travel to one task, the copies of ids
    that are known to be ``hot`` (the first of ``ids``; see ``sketch.heavy_hitters``) are split by ``spread``, any column
    that differs between them, such as the broker offset; the second step then sees a few copies of each. State is kept
    once for any other id.
    """
    if not events.isStreaming:
        others = [c for c in events.columns if c not in ids]
        order = F.struct(F.col(time).isNull().alias("late"), F.col(time).alias("time"),
                         *([spread.alias("spread")] if spread is not None else []),
                         *[F.col(c) for c in others if dict(events.dtypes)[c] != "variant"])
        first = events.groupBy(*ids).agg(F.min_by(F.struct(*events.columns), order).alias("first"))
        return first.select("first.*")
    events = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, within)
    if spread is not None and hot is not None:
        split = salted(events, ids[0], hot, F.xxhash64(spread), "part")
        cold = split.filter("part = 0")  # one part of each hot id, and all others
        rest = split.filter("part > 0").dropDuplicatesWithinWatermark([*ids, "part"])
        events = cold.unionByName(rest).drop("part")
    return events.dropDuplicatesWithinWatermark(list(ids))
