"""Incremental rows: the high-water mark, the extract after it and the keyed upsert."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tradeloom.functions.dates import moment, to_second


def last_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row with the highest value of the column, cut to seconds; NULL for an empty table."""
    return df.agg(to_second(F.max(column)).cast(df.schema[column].dataType).alias("last_watermark"))


def rows_after(
    df: DataFrame, column: str, mark: datetime | None, overlap_seconds: int = 0
) -> DataFrame:
    """Rows whose second lies after the mark's second; all rows without a mark.

    The bare comparison is the same test and reaches the Parquet footers. `overlap_seconds`
    reads that much again, for rows that changed later within the second of the mark; the
    upsert makes the repetition harmless.
    """
    if mark is None:
        return df
    first = mark.replace(microsecond=0) + timedelta(seconds=1 - overlap_seconds)
    kind = df.schema[column].dataType
    if isinstance(kind, DateType):
        # a date is its first second; the first one not before the limit is a whole day
        midnight = first.replace(hour=0, minute=0, second=0)
        first_day = midnight.date() + timedelta(days=first > midnight)
        return df.filter(F.col(column) >= F.lit(first_day))
    return df.filter(F.col(column) >= moment(first).cast(kind))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; NULL equals nothing and is no duplicate."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target with every source row put in place of the row with its key, or added.

    The source must have one row per key. NULL keys match nothing: such rows of the target
    stay, and those of the source are added. Running it again with the same source changes
    nothing, and rows deleted at the source stay.
    """
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source)
