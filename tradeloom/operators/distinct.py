"""Exact distinct counts of several columns in one pass, without one row per value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# Ids that share a word of bits, as a power of two.
WORD_BITS = 6


def with_distinct_counts(
    df: DataFrame, by: Sequence[str], distinct: Mapping[str, str], sums: Mapping[str, str] | None = None
) -> DataFrame:
    """Per group: the distinct non-NULL ids of each column in `distinct`, and the sums in `sums`.

    Both map new names to columns; ids are integers, such as surrogate keys. 64 neighbouring
    ids are the bits of one word, which tasks build before anything is shuffled: ids that
    lie close together, as keys 1..n do, leave up to 64 times fewer rows than there are distinct ids, ids far apart no
    more than that. A longer bitmap would cost its whole length for every id that lies alone. Words are
    grouped by (group, column, word), so a large group is spread over all tasks.
    """
    for column in distinct.values():
        if not isinstance(df.schema[column].dataType, IntegralType):
            raise TypeError(f"{column} is no integer")
    sums = dict(sums or {})
    empty = {f"_sum_{n}": F.lit(None).cast(df.schema[c].dataType) for n, c in sums.items()}
    filled = {f"_sum_{n}": F.col(c) for n, c in sums.items()}

    def entry(number: int, column: str | None, values: Mapping[str, Column]) -> Column:
        word, bit = (_word(column), _bit(column)) if column else (F.lit(None).cast("bigint"),) * 2
        fields = [v.alias(k) for k, v in values.items()]
        return F.struct(F.lit(number).alias("_id"), word.alias("_word"), bit.alias("_bit"), *fields)

    entries = [entry(n, c, empty) for n, c in enumerate(distinct.values())]
    # a row's values enter the sums once, in an entry without an id: it is one row per group and task, not one per word
    if sums or not entries:
        entries.append(entry(-1, None, filled))
    words = df.select(*by, F.inline(F.array(*entries)))
    merged = words.groupBy(*by, "_id", "_word").agg(
        F.bit_or("_bit").alias("_bits"), *[F.sum(f).alias(f) for f in filled]
    )
    counts = [
        F.sum(F.when(F.col("_id") == n, F.bit_count("_bits")).otherwise(0)).alias(name) for n, name in enumerate(distinct)
    ]
    return merged.groupBy(*by).agg(*counts, *[_as_summed_once(merged, f"_sum_{n}").alias(n) for n in sums])


def _word(column: str) -> Column:
    return F.shiftright(F.col(column).cast("bigint"), WORD_BITS)


def _bit(column: str) -> Column:
    place = F.col(column).cast("bigint").bitwiseAND(F.lit((1 << WORD_BITS) - 1).cast("bigint")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _as_summed_once(df: DataFrame, column: str) -> Column:
    """The sum of sums, in the type that the first sum had."""
    return F.sum(column).cast(df.schema[column].dataType)
