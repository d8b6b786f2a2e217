"""What several of these operators need: words, batches of texts, numbering, folds."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tradeloom.session import settled, stage, unstage

# A word: characters other than the ASCII white space. Fixed by the contracts.
WORD = r"[^\x20\x09-\x0D]+"
# Rows that Spark hands to Python at once; with long texts the bytes of a batch stay small.
BATCH_ROWS = 400

__all__ = [
    "BATCH_ROWS", "WORD", "count_words", "doc_fold", "kept_by_worker", "map_batches", "number_rows", "settled", "stage", "table", "unstage", "words"
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), F.array().cast("array<string>"))


def count_words(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def doc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`. A NULL id falls into fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, token: str | None = None
) -> DataFrame:
    """`mapInArrow` with batches small enough for long texts; give the token of what the function keeps by worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(token)
        yield from function(batches)

    return df.mapInArrow(run, schema)


_KEPT: dict[str, object] = {}


def drop_kept(token: str | None) -> None:
    """Free what this Python worker keeps for other tokens: a worker outlives its stage, and its memory counts in the next."""
    if _KEPT and token not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def kept_by_worker(token: str, make: Callable[[], object]) -> object:
    """What `make` gave the first task of this Python worker with the token; only the latest is kept.

    For caches that later tasks of a worker can use again; results must not depend on them.
    """
    if token not in _KEPT:
        _KEPT.clear()
        _KEPT[token] = make()
    return _KEPT[token]


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows 0..n-1 in sort order, without one task that holds them.

    Spark range-partitions and sorts; the numbered parts are stored, and a row's number is
    its place in its part plus the rows of the parts before it. Make `order` unique, so
    that equal rows can be split over parts.
    """
    placed = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1).cast(LongType()))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(parts), "_part")  # one row per part of the sort
        .withColumn(name, F.col("_before") + place)
        .drop("_part", "_before", "_at")
    )


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast(StringType()), F.lit(""))
