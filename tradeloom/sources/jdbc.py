"""Reading from and publishing to a relational database through JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tradeloom.operators.merge import rows_after
from tradeloom.sources.layers import count_while


@dataclass(frozen=True)
class Database:
    """Where a database is, and how to log in."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        login = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {**{k: v for k, v in login.items() if v is not None}, **self.options}


@dataclass(frozen=True)
class Split:
    """How many connections read a table, and the numeric or time column that divides it."""

    column: str
    lower: str
    upper: str
    parts: int

    def reader_options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.parts),
        }


# Rows that one connection reads, and connections at most: a database serves only so many.
ROWS_PER_PART = 1_000_000
MOST_PARTS = 32


def bounds_query(table: str, column: str, changed: str | None = None, mark: datetime | None = None) -> str:
    """The query for the lowest and highest value of a column and the number of rows, after the mark if there is one."""
    query = f"SELECT MIN({column}) AS lowest, MAX({column}) AS highest, COUNT(*) AS row_count FROM {table}"
    if changed and mark:
        query += f" WHERE {changed} >= '{mark.replace(microsecond=0).isoformat()}'"
    return query


def derive_split(
    column: str, lowest: int | None, highest: int | None, rows: int, rows_per_part: int = ROWS_PER_PART, most: int = MOST_PARTS
) -> Split | None:
    """Connections in proportion to the rows, none of them for less than one id; None where one connection is enough."""
    if lowest is None or highest is None:
        return None
    parts = min(most, -(-rows // rows_per_part), int(highest) - int(lowest) + 1)
    # Spark's upper bound is exclusive; rows outside the bounds are read all the same
    return Split(column, str(int(lowest)), str(int(highest) + 1), parts) if parts > 1 else None


def find_split(
    spark: SparkSession, database: Database, table: str, key: str, changed: str | None = None, mark: datetime | None = None
) -> Split | None:
    """How to divide a read by an integer key, from one small query to the database."""
    options = {**database.reader_options(), "query": bounds_query(table, key, changed, mark)}
    found = spark.read.format("jdbc").options(**options).load().first()
    return derive_split(key, found[0], found[1], int(found[2]))


def read_table(
    spark: SparkSession, database: Database, table: str, split: Split | None = None, fetch_size: int = 10_000
) -> DataFrame:
    """A whole table. Filters and columns chosen later are pushed into the database's query."""
    options = {**database.reader_options(), "dbtable": table, "fetchsize": str(fetch_size)}
    if split:
        options.update(split.reader_options())
    return spark.read.format("jdbc").options(**options).load()


def read_incremental(
    spark: SparkSession,
    database: Database,
    table: str,
    column: str,
    mark: datetime | None,
    split: Split | None = None,
    overlap_seconds: int = 0,
) -> DataFrame:
    """Rows whose second is after the mark's, as a plain comparison that the database evaluates."""
    return rows_after(read_table(spark, database, table, split), column, mark, overlap_seconds)


def publish_table(df: DataFrame, database: Database, table: str, batch_size: int = 10_000, parts: int = 8) -> dict:
    """Replace a database table, count it there and compare with the rows written."""
    options = {**database.reader_options(), "dbtable": table}
    written = {**options, "batchsize": str(batch_size), "numPartitions": str(parts)}
    rows = count_while(df, lambda out: out.write.format("jdbc").options(**written).mode("overwrite").save())
    found = df.sparkSession.read.format("jdbc").options(**options).load().count()
    return {"table": table, "source_count": rows, "published_count": found, "ok": rows == found}
