"""Upsert of a set of changes into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.session import staged


def _made_id(kind: str, key: Column) -> Column:
    """A 24-digit hexadecimal id derived from the key, so a repeated job makes the same id."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(kind), key.cast("string"))), 1, 24)


def merge_keyed(base: DataFrame, changes: DataFrame, id_column: str, keys: Sequence[str],
                seq: str = "seq") -> DataFrame:
    """The table after all changes, with ``action`` created, updated or unchanged.

    Changes act in the order of ``seq``. A change finds its row by the first key; the second key is tried only when the
    change lacks the first; what finds no row creates one. Fields that are set overwrite. Where a key is not unique,
    the stored row with the least id is meant, else the row created first. Of changes with the same ``seq``, those
    with the first key come first.

    Changes are collapsed per key before any join (the newest set value of every field, which
    combines in the map tasks), so a hot key is one row when it meets the table. Only second keys that change hands
    between the changes that ask for them are looked up change by change.
    """
    first, second = keys[0], (keys[1] if len(keys) > 1 else None)
    fields = [c for c in changes.columns if c in base.columns and c != id_column]
    stamped = changes.select(
        *[F.col(k).alias(f"key_{k}") for k in keys], F.col(seq).alias("at"),
        *[F.when(F.col(c).isNotNull(), F.struct(F.col(seq).alias("seq"), F.col(c).alias("v"))).alias(c)
          for c in fields])

    def collapsed(df: DataFrame, *by: str, more: Sequence[Column] = ()) -> DataFrame:
        return df.groupBy(*by).agg(*[F.max(c).alias(c) for c in fields], *more)

    ids = base.select(F.col(id_column).cast("string").alias("known"), *keys)
    key1 = f"key_{first}"
    by_first = collapsed(stamped.filter(F.col(key1).isNotNull()), key1, more=[F.min("at").alias("since")])
    known1 = ids.filter(F.col(first).isNotNull()).groupBy(F.col(first).alias(key1)).agg(
        F.min("known").alias("known"))
    found1 = by_first.join(known1, key1, "left").withColumn(
        "entity", F.coalesce("known", _made_id(first, F.col(key1))))
    if second is not None:
        found1 = staged(found1, "first-keys")
    parts = [found1.select("entity", *fields)]
    rest = stamped.filter(F.col(key1).isNull())

    if second is not None:
        key2 = f"key_{second}"
        weak = rest.filter(F.col(key2).isNotNull())
        strong = stamped.filter(F.col(key1).isNotNull() & F.col(key2).isNotNull()).join(
            found1.select(key1, "entity", "known", "since"), key1).select(
            "entity", "at", F.col(key2).alias("value"), _rank("known", "since", "entity"))
        stored = ids.filter(F.col(second).isNotNull()).select(
            F.col("known").alias("entity"), F.lit(None).cast(strong.schema["at"].dataType).alias("at"),
            F.col(second).alias("value"), _rank("known", F.lit(0), "known"))
        asked = weak.groupBy(F.col(key2).alias("value")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
        held = staged(_holdings(stored, strong).join(asked, "value"), "holdings")
        made = F.struct(F.lit(1).alias("kind"), F.col("made_at").cast("bigint").alias("since"),
                        _made_id(second, F.col("value")).alias("entity"))
        steady, moving = _steady(asked, held), _moving(weak.select(F.col(key2).alias("value"), "at"), held, made)
        owner = F.coalesce(F.col("holder")["entity"], _made_id(second, F.col("value")))
        parts.append(collapsed(weak.withColumnRenamed(key2, "value").join(steady, "value", "left_semi"), "value").join(
            steady, "value").select(owner.alias("entity"), *fields))
        parts.append(weak.withColumnRenamed(key2, "value").join(moving, ["value", "at"]).select(
            owner.alias("entity"), *fields))
        rest = rest.filter(F.col(key2).isNull())
    parts.append(rest.select(_made_id("row", F.col("at")).alias("entity"), *fields))

    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    news = collapsed(everything, "entity").select("entity", *[F.col(c).alias(f"new_{c}") for c in fields])
    old = base.withColumn(id_column, F.col(id_column).cast("string"))
    joined = old.join(news, F.col(id_column) == F.col("entity"), "full")
    action = (F.when(F.col(id_column).isNull(), "created").when(F.col("entity").isNotNull(), "updated")
              .otherwise("unchanged"))
    merged = [F.coalesce(F.col(f"new_{c}")["v"], F.col(c)).alias(c) if c in fields else F.col(c)
              for c in base.columns if c != id_column]
    return joined.select(F.coalesce(id_column, "entity").alias(id_column), *merged, action.alias("action"))


# ---------------------------------------------------------------- who has a second key, and when

def _rank(known: str, since: str | Column, entity: str) -> Column:
    """Order in which rows of the same key are found: stored ones by id, then created ones by the change that did it.

    A row's first key never changes, so its place does not either.
    """
    stored = F.col(known).isNotNull()
    since = F.col(since) if isinstance(since, str) else since
    return F.struct(F.when(stored, 0).otherwise(1).alias("kind"), F.when(stored, 0).otherwise(since).cast("bigint").alias("since"),
                    F.col(entity).alias("entity")).alias("rank")


def _holdings(stored: DataFrame, strong: DataFrame) -> DataFrame:
    """value, rank, start and end for each time a row holds a value of the second key; null: open to that side.

    Rows that only ever hold one value, nearly all, are one group of an aggregation. The others' changes are put in order.
    """
    touched = strong.select("entity").distinct()
    resting = stored.join(touched, "entity", "left_anti").select(
        "value", "rank", F.col("at").alias("start"), F.col("at").alias("end"))
    events = strong.unionByName(stored.join(touched, "entity", "left_semi"))
    per_row = events.groupBy("entity").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.min("at").alias("start"), F.min("rank").alias("rank"),
        F.max(F.col("at").isNull()).alias("from_the_start"))
    nothing = F.lit(None).cast(strong.schema["at"].dataType)
    single = per_row.filter("low = high").select(
        F.col("low").alias("value"), "rank", F.when(~F.col("from_the_start"), F.col("start")).alias("start"),
        nothing.alias("end"))
    order = Window.partitionBy("entity").orderBy(F.col("at").asc_nulls_first(), "value")
    changing = events.join(per_row.filter("low <> high").select("entity"), "entity", "left_semi").withColumn(
        "before", F.lag("value").over(order)).filter("before IS NULL OR before <> value")
    several = changing.select("value", "rank", F.col("at").alias("start"), F.lead("at").over(order).alias("end"))
    return resting.unionByName(single).unionByName(several)


def _always_or_never() -> tuple[Column, Column]:
    """Whether a holding covers all changes that ask for its value, or none of them."""
    started = F.col("start").isNull() | (F.col("start") <= F.col("first"))
    ends_later = F.col("end").isNull() | (F.col("end") > F.col("last"))
    never = F.coalesce(F.col("start") > F.col("last"), F.lit(False)) | F.coalesce(F.col("end") <= F.col("first"), F.lit(False))
    return started & ends_later, never


def _steady(asked: DataFrame, held: DataFrame) -> DataFrame:
    """value and holder (null: a row made by the first change) where all changes that ask for a value meet the same rows."""
    always, never = _always_or_never()
    per_value = held.groupBy("value").agg(F.bool_and(always | never).alias("steady"),
                                          F.min(F.when(always, F.col("rank"))).alias("holder"))
    return asked.select("value").join(per_value, "value", "left").filter("steady IS NULL OR steady").select("value", "holder")


def _moving(weak: DataFrame, held: DataFrame, made: Column) -> DataFrame:
    """value, at and holder of the changes that ask for a value while it changes hands.

    The first change that meets no row makes one, which holds the value from then on.
    """
    always, never = _always_or_never()
    moving = held.groupBy("value").agg(F.bool_and(always | never).alias("steady")).filter("NOT steady").select("value")
    asks = weak.join(moving, "value", "left_semi").distinct()
    spans = held.select("value", "rank", "start", "end")
    here = (F.col("start").isNull() | (F.col("start") <= F.col("at"))) & (F.col("end").isNull() | (F.col("at") < F.col("end")))
    met = asks.join(spans, "value").filter(here).groupBy("value", "at").agg(F.min("rank").alias("rank"))
    asks = asks.join(met, ["value", "at"], "left")
    first = asks.filter("rank IS NULL").groupBy("value").agg(F.min("at").alias("made_at"))
    return asks.join(first, "value", "left").select("value", "at", F.when(
        F.col("made_at").isNull() | (F.col("at") < F.col("made_at")), F.col("rank")).otherwise(
        F.when(F.col("rank") < made, F.col("rank")).otherwise(made)).alias("holder"))
