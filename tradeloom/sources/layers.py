"""Layer tables on storage: read, full refresh, keyed upsert, snapshot and catalog entry."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.checks import fingerprint, fingerprint_parts
from tradeloom.operators.merge import duplicate_keys, last_watermark, upsert
from tradeloom.sources.versions import KEY_RANGE, LAYERS, current_version, layer_path

__all__ = ["KEY_RANGE", "LAYERS", "read_layer", "table_path", "write_table", "write_upsert"]

KEYS_PER_RANGE = 10_000_000


def table_path(root: str, layer: str, table: str) -> str:
    """Where a table of a layer without versions is."""
    return f"{layer_path(root, layer)}/{table}"


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """A table of the layer's current version. Read tables that belong together from one `current_version`."""
    return current_version(spark, root, layer).read(spark, table)


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None where nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def observe_while(
    df: DataFrame, action: Callable[[DataFrame], None], totals: Mapping[str, Column] | None = None
) -> dict[str, object]:
    """Run an action on the frame; count its rows and take totals on the way, without a second pass.

    The totals are taken in the tasks that write, of which each counts once however often it is tried.
    """
    seen = Observation()
    action(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (totals or {}).items()]))
    return seen.get


def count_while(df: DataFrame, action: Callable[[DataFrame], None]) -> int:
    """Run an action on the frame and count its rows on the way, without a second pass."""
    return observe_while(df, action)["rows"]


def write_observed(
    df: DataFrame,
    path: str,
    totals: Mapping[str, Column] | None = None,
    files: int | None = None,
    partition_by: Iterable[str] = (),
) -> dict[str, object]:
    """Replace data and schema of a table; returns its `rows` and the totals of what was written.

    `files` merges small results into that many files; leave it out for large tables.
    `partition_by` lays a large table out by columns that readers filter on.
    """
    columns = list(partition_by)
    out = df if files is None else df.coalesce(files)
    if columns:
        # few files per value, and a value that is too large for one task is split
        out = out.hint("rebalance", *columns)
    return observe_while(out, lambda o: o.write.mode("overwrite").partitionBy(*columns).parquet(path), totals)


def write_table(df: DataFrame, path: str, files: int | None = None, partition_by: Iterable[str] = ()) -> int:
    """`write_observed` for the number of rows alone."""
    return write_observed(df, path, None, files, partition_by)["rows"]


def stored_watermark(spark: SparkSession, path: str, column: str) -> datetime | None:
    """The highest time that a stored table holds, in whole seconds; None for a table that is absent or empty."""
    stored = table_or_none(spark, path)
    return None if stored is None else watermark_of(stored, column)


def watermark_of(df: DataFrame, column: str) -> datetime | None:
    """The highest time of a frame in whole seconds, taken as text, in the session's zone rather than that of the Python process."""
    text = last_watermark(df, column).select(F.col("last_watermark").cast("string")).first()[0]
    return datetime.fromisoformat(text) if text else None


def write_upsert(
    spark: SparkSession, source: DataFrame, path: str, key: str, keys_per_range: int = KEYS_PER_RANGE
) -> int:
    """Upsert by an integer key, rewriting only the key ranges that the source touches.

    The table is partitioned by range of key. Spark writes the new partitions beside the
    old ones and swaps them when the job has succeeded. Two source rows with one key are
    an error, NULL keys apart: they match nothing, are all kept, and have a range of their own.
    The source has the columns of the table. It is read several times: pass a stored frame.
    """
    if not duplicate_keys(source, [key]).isEmpty():
        raise ValueError(f"several source rows share one {key}")
    keyed = source.withColumn(KEY_RANGE, F.expr(f"`{key}` div {keys_per_range}"))
    target = table_or_none(spark, path)
    merged = keyed
    if target is not None:
        if set(target.columns) != set(keyed.columns):
            raise ValueError(f"columns differ from the stored table: {sorted(set(target.columns) ^ set(keyed.columns))}")
        # as literals they prune the partitions read; the driver lists a table's partitions in any case
        listed = [row[0] for row in keyed.select(KEY_RANGE).distinct().collect()]
        touched = target.filter(F.col(KEY_RANGE).isin([r for r in listed if r is not None]))
        if None in listed:
            touched = touched.unionByName(target.filter(F.col(KEY_RANGE).isNull()))
        merged = upsert(touched, keyed, [key])
    # gathers each range in few files, and splits a range that is too large for one task
    gathered = merged.hint("rebalance", KEY_RANGE)
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(KEY_RANGE).parquet(path)
    return source.count()


def export_snapshot(df: DataFrame, path: str, files: int | None = None) -> dict:
    """Write a table for other tools, read it back and compare rows, ordered columns and content.

    The content is compared by its fingerprint, which is taken of the rows as they are written.
    """
    written = write_observed(df, path, fingerprint_parts(df), files)
    copy = df.sparkSession.read.parquet(path)
    found = fingerprint(copy).first().asDict()
    same = copy.columns == df.columns
    content = all(found[name] == written[name] for name in fingerprint_parts(df))
    return {
        "table": path.rsplit("/", 1)[-1],
        "source_count": written["rows"],
        "snapshot_count": found["row_count"],
        "columns_match": same,
        "content_matches": content,
        "ok": written["rows"] == found["row_count"] and same and content,
        "path": path,
    }


def require_ok(results: Iterable[dict]) -> None:
    """Fail the job when any export or publication does not match its source."""
    bad = [r["table"] for r in results if not r["ok"]]
    if bad:
        raise RuntimeError(f"copies differ from their sources: {', '.join(bad)}")


def register_tables(spark: SparkSession, root: str, layer: str, tables: Iterable[str]) -> list[str]:
    """Enter a layer's tables in the session catalog as <layer>_<table>, for ad-hoc SQL.

    The entries are views of the current version's files, so that they show what `read_layer`
    does: every partition of an upserted table, without the column that splits it. A
    refresh enters the tables that have an entry again.
    """
    version = current_version(spark, root, layer)
    names = []
    for table in tables:
        name = f"{layer}_{table}"
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")
        columns = ", ".join(f"`{c}`" for c in version.read(spark, table).columns)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{version.path(table)}`")
        names.append(name)
    return names


def update_entries(spark: SparkSession, root: str, layer: str, tables: Iterable[str]) -> list[str]:
    """Let the catalog entries that exist follow the layer's current version."""
    return register_tables(spark, root, layer, [t for t in tables if spark.catalog.tableExists(f"{layer}_{t}")])
