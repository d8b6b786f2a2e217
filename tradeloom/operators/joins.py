"""Joins to a side with one row per key, in a form that Spark splits at hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join `facts` to `lookup`, which has at most one row per key.

    One plan at every size. Spark broadcasts a lookup that is within its limit; otherwise
    both sides are shuffled by the key, and adaptive execution splits a partition that a
    hot key, or NULL, has made large. A lookup that is itself an aggregate by the key
    goes through `spreadable` first. As in any join on names, the key columns come first.
    """
    return facts.join(lookup, on, "left")


def spreadable(lookup: DataFrame) -> DataFrame:
    """A lookup whose join Spark can split at hot keys, though it was grouped by the key.

    A grouped side has the join's partitioning already and would keep its partitions
    whole. Rebalancing its few narrow rows makes the join shuffle both sides itself.
    """
    return lookup.hint("rebalance")


def existence_flag(df: DataFrame, column: str, reference: DataFrame, reference_column: str, flag: str) -> DataFrame:
    """Add a boolean: does the value occur in the reference? NULL never does.

    The reference is made unique first, so duplicate keys in it multiply no rows.
    """
    found = (
        reference.select(F.col(reference_column).alias(column))
        .filter(F.col(column).isNotNull())
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    joined = lookup_join(df, spreadable(found), column)
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))
