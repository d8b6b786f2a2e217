"""Measures over the executive tables: growth, weighted attainment, ranks in a filter, top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.amounts import growth, safe_ratio
from tradeloom.functions.dates import month_index
from tradeloom.functions.text import kpi_card
from tradeloom.operators.ranking import dense_ranks

MONTH = 1
YEAR = 12


def with_earlier_month(
    df: DataFrame,
    values: Mapping[str, str],
    months_back: int,
    *,
    year: str = "year",
    month: str = "month",
    within: Sequence[str] = (),
) -> DataFrame:
    """Add the values of the calendar month so many months earlier, NULL if that month is absent.

    `values` maps new names to columns. `df` has one row per month and `within` group. The
    window's frame holds the one month of that index, so a gap is a gap and not the row
    before; a row without a month has no earlier one.
    """
    index = month_index(year, month)
    # without `within` these are the months of the company: one row each, whatever the sales
    frame = Window.partitionBy(*within).orderBy("_at").rangeBetween(-months_back, -months_back)
    earlier = {name: F.when(F.col("_at").isNotNull(), F.first(c).over(frame)) for name, c in values.items()}
    return df.withColumn("_at", index).withColumns(earlier).drop("_at")


def month_over_month(kpis: DataFrame) -> DataFrame:
    """Net revenue, that of the previous month and the change, company-wide."""
    rows = kpis.select("year_month", "year", "month", "net_revenue")
    return with_earlier_month(rows, {"previous_net_revenue": "net_revenue"}, MONTH).withColumn(
        "net_revenue_growth", growth("net_revenue", "previous_net_revenue")
    )


def year_over_year(kpis: DataFrame) -> DataFrame:
    """Net revenue, that of the same month a year earlier and the change."""
    rows = kpis.select("year_month", "year", "month", "net_revenue")
    return with_earlier_month(rows, {"last_year_net_revenue": "net_revenue"}, YEAR).withColumn(
        "net_revenue_growth", growth("net_revenue", "last_year_net_revenue")
    )


def region_month_over_month(monthly: DataFrame) -> DataFrame:
    """Month over month within each region."""
    rows = monthly.select("region_key", "region_name", "year_month", "year", "month", "net_revenue")
    compared = with_earlier_month(rows, {"previous_net_revenue": "net_revenue"}, MONTH, within=["region_key"])
    return compared.withColumn("net_revenue_growth", growth("net_revenue", "previous_net_revenue"))


def region_year_over_year(monthly: DataFrame) -> DataFrame:
    """Year over year within each region, beside the month before."""
    rows = monthly.select("region_key", "region_name", "year_month", "year", "month", "net_revenue")
    compared = with_earlier_month(rows, {"last_year_net_revenue": "net_revenue"}, YEAR, within=["region_key"])
    compared = with_earlier_month(compared, {"previous_net_revenue": "net_revenue"}, MONTH, within=["region_key"])
    return compared.withColumn("net_revenue_growth", growth("net_revenue", "last_year_net_revenue"))


def attainment(target_vs_actual: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attainment of a group: the sum of actuals over the sum of targets, never a mean of ratios."""
    sums = target_vs_actual.groupBy(*by).agg(
        F.sum("actual_net_revenue").alias("actual_net_revenue"), F.sum("target_value").alias("target_value")
    )
    return sums.withColumn("target_attainment", safe_ratio("actual_net_revenue", "target_value"))


def attainment_change(target_vs_actual: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Attainment per month, that of the previous month and the difference in points."""
    months = attainment(target_vs_actual, [*within, "target_year", "target_month"])
    compared = with_earlier_month(
        months,
        {"previous_attainment": "target_attainment"},
        MONTH,
        year="target_year",
        month="target_month",
        within=within,
    )
    return compared.withColumn("attainment_change_pp", F.col("target_attainment") - F.col("previous_attainment"))


def rank_selected(
    df: DataFrame, filters: Mapping[str, Sequence[object]], rank: str, metric: str = "net_revenue"
) -> DataFrame:
    """Apply the slicers, then rank what is left."""
    selected = df
    for column, wanted in filters.items():
        selected = selected.filter(F.col(column).isin(list(wanted)))
    return dense_ranks(selected, {rank: metric})


def top(df: DataFrame, metric: str, key: str, n: int = 10) -> DataFrame:
    """The n rows with the highest value; equal values in key order.

    Give it the totals alone and look the names of what is left up afterwards.
    """
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(key).asc()).limit(n)


def kpi_cards(kpis: DataFrame, currency: str = "R$") -> DataFrame:
    """Net revenue with its month-over-month change as text."""
    card = kpi_card("net_revenue", "net_revenue_growth", currency)
    return month_over_month(kpis).select("year_month", card.alias("card"))
