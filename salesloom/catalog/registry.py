"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.catalog.bindings import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles with six decimals, by the same arithmetic as six() in the SQL twins."""
    return df.select(*[(F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c) if kind == "double" else F.col(c)
                       for c, kind in df.dtypes])


def expand_six(sql: str) -> str:
    """six(x) in a SQL twin stands for x with six decimals."""
    while (start := sql.find("six(")) >= 0:
        depth, end = 1, start + 4
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:start]}(floor(({sql[start + 4:end - 1]}) * 1e6 + 0.5) / 1e6){sql[end:]}"
    return sql


_tables: dict[tuple[str, str], Tables] = {}


def tables_of(spark: SparkSession, folder: str) -> Tables:
    """Inputs of a folder, built once per application: footers are read once, plans stay lazy."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables[key] = Tables(spark, folder)
    return _tables[key]


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: rounded(build(tables_of(spark, folder)))
        if sql is not None:
            SQL[name] = expand_six(with_views(sql))
        return build
    return register
