"""Display names of employees and products, with their fall-back chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Company suffixes cut from employee names, and names made when none is known.
COMPANY_SUFFIX = r"(?i)\s*-\s*(شركة|Company).*$"
COMPANY_WORD = "شركة|Company"
LOOKS_LIKE_ID = r"(?i)^[0-9a-f]{4,}$"
UNKNOWN_EMPLOYEE = "Unknown Employee"
UNKNOWN_NAME = "Unknown"
UNKNOWN_POSITION = "N/A"


def filled(c: Column) -> Column:
    """Trimmed text, null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def numbered_employee(employee_id: Column) -> Column:
    text = employee_id.cast("string")
    return F.when(F.length(text) > 0, F.concat(F.lit("Employee "), F.right(text, F.lit(4)))
                  ).otherwise(UNKNOWN_EMPLOYEE)


def resolve_employee_name(employee_id: Column, *candidates: Column) -> Column:
    """First filled candidate name; else "Employee " and the last 4 characters of the id (4 at least)."""
    text = employee_id.cast("string")
    made = F.when(F.length(text) >= 4, numbered_employee(text)).otherwise(UNKNOWN_EMPLOYEE)
    return F.coalesce(*[filled(c) for c in candidates], made)


def resolve_product_name(*candidates: Column) -> Column:
    return F.coalesce(*[filled(c) for c in candidates])


def clean_employee_name(name: Column, employee_id: Column) -> Column:
    """Name without its company suffix; blank, very short or id-like names give the numbered name.

    A company is what stands behind the first " - " and holds the word anywhere, or begins with it after a dash.
    """
    parts = F.split(F.trim(name), " - ")
    whole = F.when(F.get(parts, F.lit(1)).rlike(COMPANY_WORD), F.trim(F.get(parts, F.lit(0)))).otherwise(F.trim(name))
    cut = F.trim(F.regexp_replace(whole, COMPANY_SUFFIX, ""))
    usable = cut.isNotNull() & (F.length(cut) >= 3) & ~F.coalesce(cut.rlike(LOOKS_LIKE_ID), F.lit(True))
    return F.when(usable, cut).otherwise(numbered_employee(employee_id))
