"""Result tables that are kept up to date by micro-batches.

A table is split into parts by a hash of its key. A batch brings additive changes; the parts they touch are read, merged
and written whole as generation N (the batch's number), the others stay as they are. The newest finished generation
of each part is the table. Batch N starts from generations before N only, so a replay gives the same rows, whatever the
failed attempt left. Older generations are removed, but for the last ones, which open readers and a replay need.

Folder layout: <table>/schema, <table>/gen=N/part=P; Spark's _SUCCESS file marks a finished generation.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


PARTS = 16       # of a table; at scale one for each gigabyte it will hold
GENERATIONS = 2  # of a part that stay: the current one, and the one a replay starts from


@dataclasses.dataclass(frozen=True)
class Kept:
    """Keys of a kept table and how each of its columns is merged."""

    name: str
    keys: Sequence[str]
    money: Sequence[str] = ()     # added up exactly
    counts: Sequence[str] = ()    # added up
    peaks: Sequence[str] = ()     # the largest value
    texts: Sequence[str] = ()     # the least value
    sketches: Sequence[str] = ()  # sketches of distinct values, united

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.money, *self.counts, *self.peaks, *self.texts, *self.sketches]


def stamp(df: DataFrame, batch_id: int) -> DataFrame:
    """Time and batch of an update, for stored copies of a result table."""
    return df.withColumn("updatedAt", F.current_timestamp()).withColumn("window", F.lit(f"batch_{batch_id}"))


# ---------------------------------------------------------------- folders

def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.delete(path, True)


def _number(name: str, key: str) -> int | None:
    return int(name[len(key) + 1:]) if name.startswith(f"{key}=") else None


def finished(spark: SparkSession, folder: str) -> list[int]:
    """The finished generations in a folder; there are a few at most."""
    numbers = [n for n in (_number(name, "gen") for name in _names(spark, folder)) if n is not None]
    return [n for n in numbers if "_SUCCESS" in _names(spark, f"{folder}/gen={n}")]


def generations(spark: SparkSession, root: str, table: Kept) -> dict[int, set[int]]:
    """The parts of each finished generation; there are a few generations for each part at most."""
    out = {}
    for name in _names(spark, f"{root}/{table.name}"):
        n = _number(name, "gen")
        if n is not None:
            inside = _names(spark, f"{root}/{table.name}/{name}")
            if "_SUCCESS" in inside:
                out[n] = {p for p in (_number(x, "part") for x in inside) if p is not None}
    return out


def remove_superseded(spark: SparkSession, root: str, table: Kept, keep: int = GENERATIONS) -> None:
    """Remove all but the ``keep`` newest generations of each part, and what unfinished attempts before them left."""
    found = generations(spark, root, table)
    newest = max(found, default=0)
    seen: dict[int, int] = {}
    for n in sorted(found, reverse=True):
        left = set(found[n])
        for part in found[n]:
            seen[part] = seen.get(part, 0) + 1
            if seen[part] > keep:
                remove(spark, f"{root}/{table.name}/gen={n}/part={part}")
                left.discard(part)
        if not left and n < newest:
            remove(spark, f"{root}/{table.name}/gen={n}")
    for name in _names(spark, f"{root}/{table.name}"):
        n = _number(name, "gen")
        if n is not None and n < newest and n not in found:
            remove(spark, f"{root}/{table.name}/{name}")


# ---------------------------------------------------------------- reading and merging

def _schema(spark: SparkSession, root: str, table: Kept) -> T.StructType:
    return spark.read.parquet(f"{root}/{table.name}/schema").schema


def read(spark: SparkSession, root: str, table: Kept, before: int | None = None,
         only: Sequence[int] | None = None) -> DataFrame:
    """The stored rows, or their state before a batch, or only some parts; empty before the first batch."""
    newest: dict[int, int] = {}
    for n, parts in generations(spark, root, table).items():
        if before is None or n < before:
            newest.update({p: n for p in parts if n > newest.get(p, -1) and (only is None or p in only)})
    schema = _schema(spark, root, table)
    if not newest:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/{table.name}/gen={n}/part={p}" for p, n in sorted(newest.items())]
    return spark.read.schema(schema).parquet(*folders)


def merge(delta: DataFrame, batch_id: int, root: str, table: Kept, parts: int = PARTS) -> DataFrame:
    """Merge additive changes (one row for each key) into a table; the rows as they are now of all changed keys.

    Beside the table's columns a row has the batch that made it (``first_batch``), the last one that changed it
    (``batch_id``), and that one's ``updatedAt`` and ``window``.
    """
    spark = delta.sparkSession
    part = F.pmod(F.xxhash64(*table.keys), F.lit(parts)).cast("int").alias("part")
    number = F.lit(batch_id).cast("bigint")
    new = stamp(delta.select(*table.columns, number.alias("first_batch"), number.alias("batch_id")), batch_id)
    if "schema" not in _names(spark, f"{root}/{table.name}"):
        new.limit(0).write.mode("overwrite").parquet(f"{root}/{table.name}/schema")
    touched = [r.part for r in new.select(part).distinct().collect()]  # at most ``parts`` numbers
    if not touched:
        return spark.createDataFrame([], new.schema)
    both = read(spark, root, table, batch_id, touched).unionByName(new).select("*", part).repartition("part")
    kinds = dict(new.dtypes)
    merged = both.groupBy("part", *table.keys).agg(
        *[F.sum(c).cast(kinds[c]).alias(c) for c in (*table.money, *table.counts)],  # too large a sum is an error
        *[F.max(c).alias(c) for c in table.peaks], *[F.min(c).alias(c) for c in table.texts],
        *[F.hll_union_agg(c).alias(c) for c in table.sketches],
        F.min("first_batch").alias("first_batch"), F.max("batch_id").alias("batch_id"),
        F.max("updatedAt").alias("updatedAt"))
    target = f"{root}/{table.name}/gen={batch_id}"
    (merged.withColumn("window", F.concat(F.lit("batch_"), F.col("batch_id").cast("string")))
     .write.mode("overwrite").partitionBy("part").parquet(target))
    remove_superseded(spark, root, table)
    return spark.read.schema(new.schema).parquet(target).filter(F.col("batch_id") == batch_id)
