"""The ledger behind a continuously maintained result table.

Every micro-batch writes its windows under its batch id, replacing what an earlier attempt of the same
batch left, so a replay changes nothing. A table is the ledger read back: per window and key the value
of the last batch, then added up per key. ``compact`` folds old batches so reads stay short.

Folder layout: batches/batch_id=N, base/gen=N (everything up to batch N), commits/gen=N (base N is whole).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.measures import total

WINDOW = ["window_start", "window_end"]


@dataclasses.dataclass(frozen=True)
class Columns:
    """Keys of a windowed stream, its additive columns and its descriptive ones."""

    keys: Sequence[str]
    sums: Sequence[str]
    texts: Sequence[str] = ()


def write_batch(df: DataFrame, batch_id: int, root: str) -> None:
    """Idempotent write of one micro-batch; failures reach the query, which retries the batch.

    The rebalance hint lets AQE choose a few well-filled files.
    """
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(f"{root}/batches"))


def _read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _generation(spark: SparkSession, root: str) -> int | None:
    """Newest committed generation: one number per compaction is read."""
    commits = _read_if_any(spark, f"{root}/commits")
    return None if commits is None else commits.agg(F.max("gen")).first()[0]


def read_ledger(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Newest base and the batches after it; older batches are skipped by partition pruning."""
    batches = spark.read.parquet(f"{root}/batches")
    if upto is not None:
        batches = batches.filter(F.col("batch_id") <= upto)
    gen = _generation(spark, root)
    if gen is None:
        return batches
    base = spark.read.parquet(f"{root}/base").filter(F.col("gen") == gen)
    return base.withColumnRenamed("gen", "batch_id").withColumn("batch_id", F.col("batch_id").cast("bigint")) \
        .unionByName(batches.filter(F.col("batch_id") > gen))


def last_per_window(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The running value a window had in its last batch; superseded values are dropped, not added."""
    by = [*WINDOW, *keys]
    values = [c for c in rows.columns if c not in (*by, "batch_id")]
    last = rows.groupBy(*by).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return last.select(*by, *[F.col("v")[c].alias(c) for c in values])


def merge_additive(windows: DataFrame, keys: Sequence[str], sums: Sequence[str],
                   texts: Sequence[str] = ()) -> DataFrame:
    """Windows added up per key. Averages follow from the sums, so they are weighted by count."""
    kinds = dict(windows.dtypes)
    added = [(total(c) if kinds[c] == "double" else F.sum(c)).alias(c) for c in sums]
    return windows.groupBy(*keys).agg(*added, *[F.min(c).alias(c) for c in texts])


def live_windows(spark: SparkSession, root: str, columns: Columns) -> DataFrame:
    return last_per_window(read_ledger(spark, root), columns.keys)


def live_table(spark: SparkSession, root: str, columns: Columns, keys: Sequence[str] | None = None) -> DataFrame:
    """Current sums per key (or per fewer keys)."""
    keys = list(keys or columns.keys)
    texts = [*columns.texts, *[k for k in columns.keys if k not in keys]]
    return merge_additive(live_windows(spark, root, columns), keys, columns.sums, texts)


def compact(spark: SparkSession, root: str, columns: Columns, upto: int, closed_before: str) -> None:
    """Fold all batches up to ``upto`` into a new base.

    Windows that ended by ``closed_before`` (at or before the watermark) become one row per key;
    open windows stay as they are, because later batches may replace their values.
    """
    live = last_per_window(read_ledger(spark, root, upto), columns.keys)
    closed = F.col("window_end").isNull() | (F.col("window_end") <= F.lit(closed_before).cast("timestamp"))
    folded = merge_additive(live.filter(closed), columns.keys, columns.sums, columns.texts)
    base = live.filter(~closed).unionByName(folded, allowMissingColumns=True)
    (base.withColumn("gen", F.lit(upto).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("gen").parquet(f"{root}/base"))
    (spark.range(1).select(F.lit(upto).cast("bigint").alias("gen")).write.mode("append")
     .parquet(f"{root}/commits"))
