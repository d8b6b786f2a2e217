"""Dense numbering and ranking of whole tables without one task that holds them.

The same plan serves every size; only the type of the column decides how it is numbered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, IntegralType, NumericType

from tradeloom.operators.joins import lookup_join
from tradeloom.session import stage

# Ids are unique integers, so a range of 2^20 ids holds at most that many rows, and two
# levels of it leave at most 2^64 / 2^40 groups.
ID_BITS = 20
# Below every range; NULL sorts first.
NULL_RANGE = -(1 << 62)
# Ranges of values in each power of two, as a power of two.
RANGE_BITS = 16


def surrogate_key(df: DataFrame, key: str, order_column: str, *, id_bits: int = ID_BITS) -> DataFrame:
    """Number the rows 1..n by a unique column; equal input gives equal keys. NULL comes first.

    Integers are numbered within ranges of ids and the ranges among themselves, in a lazy
    plan. Other types, such as text, are sorted by range partitions, which are stored.
    """
    if not isinstance(df.schema[order_column].dataType, IntegralType):
        return number_sorted(df, [F.col(order_column).asc_nulls_first()], key)

    # never NULL, so that joining the starts on it reuses the window's partitioning
    range_of_id = F.shiftright(F.col(order_column).cast("bigint"), id_bits)
    ranged = df.withColumn("_range", F.coalesce(range_of_id, F.lit(NULL_RANGE)))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    sizes = sizes.withColumn("_group", F.shiftright("_range", id_bits))
    groups = sizes.groupBy(F.col("_group").alias("_group_id")).agg(F.sum("_rows").alias("_group_rows"))
    groups = groups.withColumn("_group_start", _sum_before("_group_rows", Window.orderBy("_group_id")))
    starts = (
        sizes.withColumn("_start", _sum_before("_rows", Window.partitionBy("_group").orderBy("_range")))
        .join(groups, F.col("_group") == F.col("_group_id"))
        .select("_range", (F.col("_start") + F.col("_group_start")).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(order_column).asc_nulls_first()))
    return (
        ranged.withColumn("_nth", within)
        .join(starts, "_range")
        .withColumn(key, (F.col("_nth") + F.col("_start")).cast("bigint"))
        .drop("_range", "_nth", "_start")
    )


def dense_ranks(df: DataFrame, ranks: Mapping[str, str], *, within: Sequence[str] = ()) -> DataFrame:
    """Add dense ranks, highest value first, equal values equal, NULL last.

    `ranks` maps each new column to the column it ranks; `within` restarts the ranks per
    group. Numbers are ranked by fixed ranges of values: a rank is the place among the
    distinct values of its range plus the values of all higher ranges, so that beyond a range only
    counts meet. The plan is lazy for integers and decimals. Floats are stored first, since a
    sum of floats may differ each time it is taken and then misses its own rank. Other types, such as text,
    are stored and sorted. The plan reads `df` several times: store what is costly to compute.
    """
    kinds = {name: df.schema[metric].dataType for name, metric in ranks.items()}
    numbers = {n: m for n, m in ranks.items() if isinstance(kinds[n], NumericType)}
    others = {n: m for n, m in ranks.items() if n not in numbers}
    group = F.to_json(F.struct(*within), {"ignoreNullFields": "false"}) if within else F.lit("")
    ranked = df.withColumn("_group", group)
    if not all(isinstance(kind, (IntegralType, DecimalType)) for kind in kinds.values()):
        ranked = stage(ranked, "ranked")
    if numbers:
        ranked = _ranked_numbers(ranked, numbers)
    if others:
        ranked = _ranked_sorted(ranked, others)
    return ranked.select(*df.columns, *ranks)


def value_range(column: str) -> Column:
    """The number of the range of values in which a number lies: higher for higher numbers, NULL lowest.

    Every power of two is cut into 2^16 ranges of equal width. Numbers that a double does not
    tell apart share a range.
    """
    value = F.col(column).cast("double")
    size = F.abs(value)
    octave = F.floor(F.log2(size)).cast("double")
    # size / 2^octave is exact; should log2 err at a power of two, the sum is still the same there
    place = F.floor((octave + size / F.pow(F.lit(2.0), octave) + 1100) * (1 << RANGE_BITS)).cast("bigint")
    place = F.when(F.isnan(value) | (size == float("inf")), F.lit(1 << 40) + F.isnan(value).cast("bigint")).otherwise(place)
    signed = F.when(value > 0, place).when(value < 0, -place).otherwise(F.lit(0).cast("bigint"))
    return F.when(F.col(column).isNull(), F.lit(NULL_RANGE)).otherwise(signed)


def _ranked_numbers(rows: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """Rank all metrics' distinct values in one pass and join the ranks back."""
    kinds = {name: rows.schema[metric].dataType for name, metric in ranks.items()}
    # one column per type, in which a value compares as in its own; the others are NULL
    slots = {kind: f"_value{n}" for n, kind in enumerate(dict.fromkeys(kinds.values()))}

    def keys(name: str) -> dict[str, Column]:
        value = F.coalesce(ranks[name], F.lit(0).cast(kinds[name]))
        return {"_range": value_range(ranks[name]), slots[kinds[name]]: value}

    def entry(number: int, name: str) -> Column:
        key = keys(name)
        values = [key.get(slot, F.lit(None).cast(kind)).alias(slot) for kind, slot in slots.items()]
        return F.struct(F.lit(number).alias("_rank"), key["_range"].alias("_range"), *values)

    entries = F.array(*[entry(number, name) for number, name in enumerate(ranks)])
    values = rows.select("_group", F.inline(entries)).distinct()
    placed = _placed_in_ranges(values, [F.col(slot).desc() for slot in slots.values()])
    for number, name in enumerate(ranks):
        key = keys(name)
        own = placed.filter(F.col("_rank") == number).select("_group", *key, F.col("_place").cast("int").alias(name))
        rows = lookup_join(rows.withColumns(key), own, ["_group", *key]).drop(*key)
    return rows


def _placed_in_ranges(values: DataFrame, order: list[Column]) -> DataFrame:
    """Number the values 1..n from the top within `_rank` and `_group`, given the range of each.

    Values are sorted range by range. What meets by metric and group is one count for each
    range: a power of two has 2^16 of these however many values there are.
    """
    metric = ["_rank", "_group"]
    nth = F.row_number().over(Window.partitionBy(*metric, "_range").orderBy(*order))
    sorted_values = values.withColumn("_nth", nth)
    sizes = sorted_values.groupBy(*metric, "_range").agg(F.max("_nth").alias("_size"))
    above = _sum_before("_size", Window.partitionBy(*metric).orderBy(F.desc("_range")))
    starts = sizes.select(*metric, "_range", above.alias("_start"))
    placed = sorted_values.join(starts, [*metric, "_range"])
    return placed.withColumn("_place", F.col("_nth") + F.col("_start"))


def _ranked_sorted(stored: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """Ranks of values of any orderable type: one stored sort per type, ranks counted on from its parts."""
    kinds = {name: stored.schema[metric].dataType for name, metric in ranks.items()}

    def keys(name: str) -> dict[str, Column]:
        # the text of a value tells it from the others; NULL is told by `_known`
        text = F.hex(ranks[name]) if isinstance(kinds[name], BinaryType) else F.col(ranks[name]).cast("string")
        return {"_known": F.col(ranks[name]).isNotNull(), "_text": F.coalesce(text, F.lit(""))}

    ranked = stored
    for kind in dict.fromkeys(kinds.values()):
        alike = [n for n in ranks if kinds[n] == kind]
        entries = [
            F.struct(F.lit(n).alias("_rank"), *[c.alias(k) for k, c in keys(n).items()], F.col(ranks[n]).alias("_value"))
            for n in alike
        ]
        values = stored.select("_group", F.inline(F.array(*entries))).distinct()
        order = [F.asc("_rank"), F.asc("_group"), F.desc("_known"), F.desc("_value")]
        sorted_values, _ = _sorted_parts(values, order)
        # few: the groups that begin or go on in each part of the sort
        metric = ["_rank", "_group"]
        parts = sorted_values.groupBy(*metric, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
        before = _sum_before("_rows", Window.partitionBy(*metric).orderBy("_part"))
        parts = parts.select(*metric, "_part", (before + 1 - F.col("_first")).alias("_shift"))
        placed = sorted_values.join(parts, [*metric, "_part"]).withColumn("_place", F.col("_place") + F.col("_shift"))
        for name in alike:
            own = placed.filter(F.col("_rank") == name).select("_group", "_known", "_text", F.col("_place").cast("int").alias(name))
            ranked = lookup_join(ranked.withColumns(keys(name)), own, ["_group", "_known", "_text"]).drop("_known", "_text")
    return ranked


def number_sorted(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number the rows 1..n in sort order, for any orderable columns.

    Spark's range partitioner spreads the sort. Every row is stored with its partition and
    its place there; its number is that place plus the rows of the partitions before, of
    which there are at most as many as shuffle partitions.
    """
    stored, parts = _sorted_parts(df, order)
    parts = parts.withColumn("_before", _sum_before("_rows", Window.orderBy("_part"))).drop("_rows")
    return (
        stored.join(F.broadcast(parts), "_part")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_part", "_place", "_before")
    )


def _sorted_parts(df: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The sorted rows, stored, with `_part` and `_place` (from 0) in it; and the rows of each part."""
    stored = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1).cast("bigint"))  # Spark's lower 33 bits
    placed = stored.withColumns({"_part": F.shiftright("_at", 33), "_place": place}).drop("_at")
    return placed, placed.groupBy("_part").agg(F.count("*").alias("_rows"))


def _sum_before(column: str, window: Window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
