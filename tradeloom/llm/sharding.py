"""Shards by jump consistent hashing: a key's shard follows from the key and the shard count alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import number_rows, table

# Fixed values of the published algorithm: the multiplier of its 64-bit congruential
# generator, as the halves high * 2^32 + low.
MULTIPLIER_HIGH, MULTIPLIER_LOW = divmod(2862933555777941757, 1 << 32)
LOW_32 = (1 << 32) - 1

SHARDS = 40


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _product(a: Column, b: int) -> tuple[Column, Column]:
    """a * b for unsigned 32-bit factors, as (high, low) 32-bit halves; no step exceeds 2^49."""
    by_low = a.bitwiseAND(_long(0xFFFF)) * _long(b)
    by_high = F.shiftright(a, 16) * _long(b)
    total = by_low + by_high.bitwiseAND(_long(0xFFFF)) * _long(1 << 16)
    return F.shiftright(total, 32) + F.shiftright(by_high, 16), total.bitwiseAND(_long(LOW_32))


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """One step of the generator, modulo 2^64."""
    carry, new_low = _product(low, MULTIPLIER_LOW)
    _, cross = _product(low, MULTIPLIER_HIGH)
    _, other = _product(high, MULTIPLIER_LOW)
    bumped = new_low + _long(1)
    new_high = carry + cross + other + F.shiftright(bumped, 32)
    return new_high.bitwiseAND(_long(LOW_32)), bumped.bitwiseAND(_long(LOW_32))


def jump_walk(key: Column, shards: int) -> Column:
    """Struct of `last`, the shard among `shards`, and `next`, the shard count that moves the key.

    The walk jumps to ever larger shard counts; it takes at most one jump per shard.
    """
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(_long(LOW_32)).alias("low"),
        _long(-1).alias("last"),
        _long(0).alias("next"),
    )

    def jump(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        draw = F.shiftright(high, 1) + _long(1)
        far = F.floor((state["next"] + _long(1)).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double")))
        moved = F.struct(
            high.alias("high"), low.alias("low"), state["next"].alias("last"), far.cast("bigint").alias("next")
        )
        return F.when(state["next"] < _long(shards), moved).otherwise(state)

    return F.aggregate(F.sequence(_long(1), _long(shards)), start, jump)


def shard_rows(df: DataFrame, key: str, shards: int = SHARDS) -> DataFrame:
    """Add `shard`, `grown_shard` (the shard with one more) and `slot` (place in the shard, from 0).

    `key` is an integer column. A NULL key counts as 0. Rows with one key share a shard. Slots follow
    key, text and the other columns; equal rows take neighbouring slots in any order. An
    empty table gives an empty one.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    walk = jump_walk(F.coalesce(F.col(key).cast("bigint"), _long(0)), shards)
    walked = df.withColumn("_walk", walk)
    placed = walked.withColumns(
        {
            "shard": F.col("_walk.last").cast("int"),
            "grown_shard": F.when(F.col("_walk.next") == shards, shards).otherwise(F.col("_walk.last")).cast("int"),
            # the same at every run; lets the sort split rows that are equal throughout
            "_tie": F.monotonically_increasing_id(),
        }
    ).drop("_walk")
    order = [F.asc("shard"), *[F.asc(c) for c in [key, *[c for c in df.columns if c != key]]], F.asc("_tie")]
    numbered = number_rows(placed, order, "_number").drop("_tie")
    first = numbered.groupBy("shard").agg(F.min("_number").alias("_first"))
    return (
        numbered.join(F.broadcast(first), "shard")  # one row per shard
        .withColumn("slot", F.col("_number") - F.col("_first"))
        .drop("_number", "_first")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by `doc_id`. A NULL text has no bytes and the checksum 0."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shard_rows(sized, "doc_id", SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


OP5_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT range AS byte, range::BIGINT AS c, 0 AS k FROM range(256)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY byte) AS entries FROM steps WHERE k = 8
), data AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), sized AS (
  SELECT doc_id, len(digits) // 2 + 16 AS size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(digits, '..'), lambda d: ('0x' || d)::BIGINT)),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)::BIGINT AS text_crc32
  FROM data, crc
), walk AS (
  SELECT DISTINCT doc_id, (CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END) AS state,
    -1::BIGINT AS last, 0::BIGINT AS next FROM documents
  UNION ALL
  SELECT doc_id, new_state, next, floor((next + 1) * (2147483648.0::DOUBLE / ((new_state >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS new_state FROM walk WHERE next < 40)
), ends AS (
  SELECT doc_id, last::INTEGER AS shard, CASE WHEN next = 40 THEN 40 ELSE last END::INTEGER AS grown_shard FROM walk WHERE next >= 40
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot
FROM sized JOIN ends USING (doc_id)
"""
