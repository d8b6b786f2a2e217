"""Checks of content that need no order and no driver-side rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MODULUS = 1_000_000_007


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and two order-independent hashes of the content: equal tables, equal row."""
    return df.agg(*[part.alias(name) for name, part in fingerprint_parts(df).items()])


def fingerprint_parts(df: DataFrame) -> dict[str, Column]:
    """The aggregates of a fingerprint, to be taken while the rows are written."""
    row_hash = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in sorted(df.columns)])
    return {
        "row_count": F.count(F.lit(1)),
        "hash_xor": F.coalesce(F.bit_xor(row_hash), F.lit(0).cast("bigint")),
        "hash_sum": F.coalesce(F.sum(F.pmod(row_hash, F.lit(_MODULUS))), F.lit(0)).cast("decimal(38,0)"),
    }
