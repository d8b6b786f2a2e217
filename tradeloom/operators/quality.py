"""Row checks that name their reasons, and the split into valid and rejected rows.

A check never drops a row. It adds its reason to an array column; one split at the end
separates the rows without a reason from the others.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.dates import moment
from tradeloom.operators.joins import existence_flag

# The columns that hold a row's reasons, while it is checked and in quarantine.
REASONS = "_rejection_reasons"
REASON_TEXT = "rejection_reason"


# --- reasons: a column that is the reason's text where the rule is broken, else NULL ---


def null_reason(column: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit(f"{column}_is_null"))


def sign_reason(column: str, allow_zero: bool = False) -> Column:
    if allow_zero:
        return F.when(F.col(column) < 0, F.lit(f"{column}_negative"))
    return F.when(F.col(column) <= 0, F.lit(f"{column}_zero_or_negative"))


def future_reason(column: str, as_of: datetime | Column | None = None) -> Column:
    return F.when(F.col(column) > moment(as_of), F.lit(f"{column}_in_future"))


def add_reasons(df: DataFrame, reasons: Iterable[Column]) -> DataFrame:
    """Append every reason that holds, in one projection; a repeated one counts once."""
    none = F.array().cast("array<string>")
    found = [F.when(r.isNotNull(), F.array(r)).otherwise(none) for r in reasons]
    added = F.concat(none, *found)
    merged = F.array_union(F.col(REASONS), added) if REASONS in df.columns else F.array_distinct(added)
    return df.withColumn(REASONS, merged)


# --- checks ---


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return add_reasons(df, [null_reason(c) for c in columns])


def check_positive(df: DataFrame, column: str, allow_zero: bool = False) -> DataFrame:
    """Zero is a violation unless allowed; NULL passes."""
    return add_reasons(df, [sign_reason(column, allow_zero)])


def check_not_future(df: DataFrame, column: str, as_of: datetime | Column | None = None) -> DataFrame:
    """A time after `as_of` (default: now) is a violation; NULL passes."""
    return add_reasons(df, [future_reason(column, as_of)])


def check_foreign_key(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str
) -> DataFrame:
    """The value must occur in the reference. NULL does not; an empty reference rejects all."""
    flagged = existence_flag(df, column, reference, reference_column, "_found")
    return _judge(df, flagged, f"{column}_not_found")


def check_has_related(
    df: DataFrame, column: str, related: DataFrame, related_column: str
) -> DataFrame:
    """At least one related row must exist."""
    flagged = existence_flag(df, column, related, related_column, "_found")
    return _judge(df, flagged, f"no_related_records_via_{related_column}")


def _judge(df: DataFrame, flagged: DataFrame, reason: str) -> DataFrame:
    """Give the reason to rows not found; the columns keep their order, the reasons come last."""
    judged = add_reasons(flagged, [F.when(~F.col("_found"), F.lit(reason))])
    return judged.select(*[c for c in df.columns if c != REASONS], REASONS)


def split_valid_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without a reason, and the others with their reasons as text."""
    checked = df if REASONS in df.columns else add_reasons(df, [])
    valid = checked.filter(F.size(REASONS) == 0).drop(REASONS)
    rejected = (
        checked.filter(F.size(REASONS) > 0).withColumn(REASON_TEXT, F.concat_ws(", ", REASONS)).drop(REASONS)
    )
    return valid, rejected


def deduplicate_latest(
    df: DataFrame, keys: list[str], order_column: str, tie_break: Iterable[str] = ()
) -> DataFrame:
    """Keep one row per key: the one with the highest `order_column`, NULL lowest.

    Rows that tie are settled by the `tie_break` columns in ascending order. Every task
    keeps one row per key before the shuffle, so copies of one key never meet in bulk.
    """
    order = [F.col(order_column).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie_break]]
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(newest_first)).filter(F.col("_nth") == 1).drop("_nth")
