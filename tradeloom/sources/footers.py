"""Counts and bounds of stored tables from the footers of their files, without reading a row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType

from tradeloom.sources.versions import LayerVersion


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table whose `count`, `min` and `max` Spark answers from the footers, where there is no filter.

    That takes a reader and a setting which the caller's session does not use, so the frame belongs to a session of its
    own beside it. Footers have no usable bounds of texts, decimals and times; these are read, one column at a time.
    """
    beside = spark.newSession()
    beside.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    beside.conf.set("spark.sql.sources.useV1SourceList", "")
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside.read.parquet(path)


def has_bounds(df: DataFrame, column: str) -> bool:
    """Whether the footers hold the bounds of a column. Those of floats leave NaN out, so they do not count."""
    return isinstance(df.schema[column].dataType, (BooleanType, DateType, IntegralType))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """One row: lowest and highest value of a column, and the number of rows."""
    return df.agg(F.min(column).alias("lowest"), F.max(column).alias("highest"), F.count("*").alias("rows"))


def stored_bounds(spark: SparkSession, path: str, column: str) -> tuple[object, object, int]:
    """Lowest and highest value of a stored column, None for an empty table, and the number of rows."""
    stored = read_footers(spark, path)
    if not has_bounds(stored, column):
        stored = spark.read.parquet(path)
    lowest, highest, rows = bounds(stored, column).first()
    return lowest, highest, rows or 0  # files without rows have footers without counts


def stored_counts(spark: SparkSession, version: LayerVersion, tables: Iterable[str]) -> Mapping[str, int]:
    """Rows of every table of a layer: as counted when they were written, or else from the footers."""
    known = version.totals(spark)

    def count(table: str) -> int:
        if table in known:
            return known[table]["rows"]
        return read_footers(spark, version.path(table)).agg(F.count("*").alias("rows")).first().rows or 0

    return {table: count(table) for table in tables}
