"""Whole tables in, shared folders for what is written between steps, and raw files in those folders."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.session import staged, work_folder  # noqa: F401

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(), "salesloom_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "salesloom")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


@contextmanager
def batches_of(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Rows that go to a Python worker at once; long texts make the usual 10,000 a large batch. It is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged_texts(df: DataFrame, purpose: str) -> DataFrame:
    """``staged`` for what Python workers make of whole texts, in small batches."""
    with batches_of(df.sparkSession):
        return staged(df, purpose)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def filesystem(uri: str):
    """pyarrow's file system of a URI or local path, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def set_aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns of these names renamed, and what gives its columns back."""
    clash = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    back = [F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns]
    return docs.withColumnsRenamed(clash), lambda out: out.select(*back)
