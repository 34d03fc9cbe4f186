"""Calendar labels and look-back periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label formats per period, and the spellings callers use for them.
LABELS = {"hour": "yyyy-MM-dd HH:00", "minute": "yyyy-MM-dd HH:mm", "day": "yyyy-MM-dd", "month": "yyyy-MM"}
SPELLINGS = {"daily": "day", "weekly": "week", "monthly": "month"}
LOOKBACK = {"day": "7 days", "week": "30 days", "month": "6 months", "year": "1 year"}


def label(ts: str | Column, period: str = "day") -> Column:
    """Text label of the period a time lies in; an unknown period means day.

    A week label joins the calendar year with the ISO week number.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    period = SPELLINGS.get(period, period)
    if period == "week":
        return F.concat(F.date_format(ts, "yyyy"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
    return F.date_format(ts, LABELS.get(period, LABELS["day"]))


def lookback_start(period: str, as_of: Column) -> Column:
    """Start of the preset look-back: 7 days, 30 days, 6 months or 1 year before ``as_of``."""
    return as_of - F.expr(f"INTERVAL {LOOKBACK[SPELLINGS.get(period, period)]}")
