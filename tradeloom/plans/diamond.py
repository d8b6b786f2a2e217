"""Diamond: executive aggregates over issued sales, and their reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.amounts import safe_ratio
from tradeloom.functions.dates import key_month, key_year, month_start, month_text
from tradeloom.operators.distinct import with_distinct_counts
from tradeloom.operators.ranking import dense_ranks
from tradeloom.session import stage

# Fixed value: the status of an invoice that counts as a sale.
ISSUED = "issued"
# Fixed value: the largest difference between two totals that still counts as equal.
TOLERANCE = 0.01
# Fixed values, here and in the tables below: the columns of every executive table, their names and their order.
MONTHS = ["year_month", "year", "month", "month_name"]
# The order in which each executive table is read.
READ_ORDER = {
    "monthly_sales": ["year_month", "region_name"],
    "product_ranking": ["rank_net_revenue"],
    "customer_ranking": ["rank_net_revenue"],
    "salesperson_performance": ["rank_net_revenue"],
    "target_vs_actual": ["target_year", "target_month", "salesperson_name"],
    "commercial_kpis": ["year_month"],
}


def in_read_order(df: DataFrame, table: str) -> DataFrame:
    """An executive table's rows in the order in which it is presented; stored tables have none."""
    return df.orderBy(*READ_ORDER[table])


def sales_base(fact_sales: DataFrame) -> DataFrame:
    """Issued sales; cancelled ones and items without an invoice (NULL status) drop out."""
    return fact_sales.filter(F.col("invoice_status") == ISSUED)


def monthly_sales(base: DataFrame, dim_region: DataFrame) -> DataFrame:
    """By month and region of the salesperson."""
    sums = _with_month_names(_by_month(base, ["region_key"], _sales_sums(discounts=True)))
    regions = dim_region.select("region_key", "region_code", "region_name")
    return _with_ratios(sums).join(regions, "region_key", "left").select(
        *MONTHS,
        "region_key",
        "region_code",
        "region_name",
        "gross_revenue",
        "net_revenue",
        "discount_amount",
        "returned_amount",
        "margin_amount",
        "margin_pct",
        "units_sold",
        "invoice_count",
        "avg_ticket",
    )


def product_ranking(base: DataFrame, fact_returns: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Per product sold; a product that was only returned does not appear."""
    rows = _entity_totals(base, fact_returns, dim_product, "product_key")
    ranks = {
        "rank_net_revenue": "net_revenue",
        "rank_margin_amount": "margin_amount",
        "rank_units_sold": "units_sold",
        "rank_returned_amount": "returned_amount",
    }
    return dense_ranks(rows, ranks).select(
        "product_key",
        "product_id",
        "product_code",
        "product_name",
        "category_name",
        "gross_revenue",
        "net_revenue",
        "margin_amount",
        "margin_pct",
        "units_sold",
        "invoice_count",
        "returned_amount",
        "returned_quantity",
        "return_rate",
        *ranks,
    )


def customer_ranking(base: DataFrame, fact_returns: DataFrame, dim_customer: DataFrame) -> DataFrame:
    rows = _entity_totals(base, fact_returns, dim_customer, "customer_key")
    ranks = {"rank_net_revenue": "net_revenue", "rank_returned_amount": "returned_amount"}
    return dense_ranks(rows, ranks).select(
        "customer_key",
        "customer_id",
        "customer_code",
        "customer_name",
        "customer_segment",
        "region_name",
        "gross_revenue",
        "net_revenue",
        "margin_amount",
        "units_sold",
        "invoice_count",
        "avg_ticket",
        "returned_amount",
        "returned_quantity",
        "return_rate",
        *ranks,
    )


def salesperson_performance(base: DataFrame, fact_returns: DataFrame, dim_salesperson: DataFrame) -> DataFrame:
    rows = _entity_totals(base, fact_returns, dim_salesperson, "salesperson_key")
    ranks = {"rank_net_revenue": "net_revenue", "rank_returned_amount": "returned_amount"}
    return dense_ranks(rows, ranks).select(
        "salesperson_key",
        "salesperson_id",
        "salesperson_code",
        "salesperson_name",
        "region_name",
        "gross_revenue",
        "net_revenue",
        "margin_amount",
        "margin_pct",
        "units_sold",
        "invoice_count",
        "avg_ticket",
        "returned_amount",
        "returned_quantity",
        "return_rate",
        *ranks,
    )


def target_vs_actual(
    base: DataFrame,
    fact_sales_targets: DataFrame,
    dim_salesperson: DataFrame,
    dim_region: DataFrame,
) -> DataFrame:
    """Targets and sales by salesperson, region and month; either may be missing.

    Without sales the actual is 0; without a target there is no attainment.
    """
    sums = {
        "actual_net_revenue": F.sum("net_revenue"),
        "actual_margin": F.sum("margin_amount"),
    }
    actual = _by_month(base, ["salesperson_key", "region_key"], sums)
    actual = actual.withColumnsRenamed({"year": "target_year", "month": "target_month"})
    keys = ["salesperson_key", "region_key", "target_year", "target_month"]
    joined = fact_sales_targets.select(*keys, "target_value").join(actual, keys, "full_outer")
    joined = joined.withColumns({name: _or_zero(joined, name) for name in sums})
    people = dim_salesperson.select("salesperson_key", "salesperson_code", "salesperson_name")
    regions = dim_region.select("region_key", "region_code", "region_name")
    return (
        joined.withColumn("target_attainment", safe_ratio("actual_net_revenue", "target_value"))
        .withColumn("has_target", F.col("target_value").isNotNull())
        .join(people, "salesperson_key", "left")
        .join(regions, "region_key", "left")
        .select(
            "salesperson_key",
            "salesperson_code",
            "salesperson_name",
            "region_key",
            "region_code",
            "region_name",
            "target_year",
            "target_month",
            "target_value",
            "actual_net_revenue",
            "actual_margin",
            "target_attainment",
            "has_target",
        )
    )


def commercial_kpis(base: DataFrame, fact_returns: DataFrame, fact_sales_targets: DataFrame) -> DataFrame:
    """Per month with sales: totals, active entities, returns by return month, targets.

    The month's target is the sum over all targets. Every target appears exactly once in
    the comparison of targets with sales, so the sum is taken from the targets themselves.
    """
    sums = {n: n for n in ("gross_revenue", "net_revenue", "margin_amount")} | {"units_sold": "quantity"}
    distinct = {
        "invoice_count": "invoice_id",
        "active_customers": "customer_key",
        "active_salespersons": "salesperson_key",
    }
    sales = _with_month_names(with_distinct_counts(_dated(base), ["year", "month"], distinct, sums))
    returned = _by_month(fact_returns, [], {"returned_amount": F.sum("returned_amount")})
    returned = _with_month_names(returned).select("year_month", "returned_amount")
    joined = sales.join(returned, "year_month", "left").join(
        targets_by_month(fact_sales_targets), "year_month", "left"
    )
    joined = joined.withColumns({name: _or_zero(joined, name) for name in ("returned_amount", "target_total")})
    return (
        _with_ratios(joined)
        .withColumn("target_attainment", safe_ratio("net_revenue", "target_total"))
        .select(
            *MONTHS,
            "gross_revenue",
            "net_revenue",
            "margin_amount",
            "margin_pct",
            "units_sold",
            "invoice_count",
            "avg_ticket",
            "active_customers",
            "active_salespersons",
            "returned_amount",
            "return_rate",
            "target_total",
            "target_attainment",
        )
    )


def monthly_activity(base: DataFrame) -> DataFrame:
    """Per month and region of the salesperson: who bought, who sold, what and how often, beside the net revenue."""
    distinct = {
        "invoice_count": "invoice_id",
        "active_customers": "customer_key",
        "active_salespersons": "salesperson_key",
        "active_products": "product_key",
    }
    return with_distinct_counts(_dated(base), ["year", "month", "region_key"], distinct, {"net_revenue": "net_revenue"})


def targets_by_month(targets: DataFrame) -> DataFrame:
    return targets.groupBy(month_text("target_year", "target_month").alias("year_month")).agg(
        F.sum("target_value").alias("target_total")
    )


def _sales_sums(discounts: bool = False) -> dict[str, Column]:
    sums = {
        "gross_revenue": F.sum("gross_revenue"),
        "net_revenue": F.sum("net_revenue"),
        "margin_amount": F.sum("margin_amount"),
        "units_sold": F.sum("quantity"),
        "invoice_count": F.count_distinct("invoice_id"),
    }
    if discounts:
        sums["discount_amount"] = F.sum("discount_amount")
        sums["returned_amount"] = F.sum("returned_amount")
    return sums


def _by_month(rows: DataFrame, keys: list[str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums by `year`, `month` and keys. The date key holds its month, so no calendar is joined."""
    return _dated(rows).groupBy("year", "month", *keys).agg(*[e.alias(name) for name, e in sums.items()])


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"year": key_year("date_key"), "month": key_month("date_key")})


def _with_month_names(df: DataFrame) -> DataFrame:
    """Add the text and the name of the month, as the calendar has them; NULL without a date."""
    text = F.when(F.col("year").isNotNull(), month_text("year", "month"))
    return df.withColumns({"year_month": text, "month_name": F.date_format(month_start("year", "month"), "MMMM")})


def _entity_totals(base: DataFrame, fact_returns: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    # one row per entity; the ranks read these rows several times, the facts are read once
    return stage(entity_totals(base, fact_returns, key).join(dimension, key, "left"), key)


def entity_totals(base: DataFrame, fact_returns: DataFrame, key: str) -> DataFrame:
    """Sales and returns of each entity sold, with ratios, without its name or ranks.

    Each group is pre-aggregated by task, and distinct invoices are counted on
    (entity, invoice) pairs, so a hot entity does not meet in one task.
    """
    sales = sales_totals(base, key)
    returned = fact_returns.groupBy(key).agg(
        F.sum("returned_amount").alias("returned_amount"), F.sum("quantity").alias("returned_quantity")
    )
    joined = sales.join(returned, key, "left")
    joined = joined.withColumns({name: _or_zero(joined, name) for name in ("returned_amount", "returned_quantity")})
    return _with_ratios(joined)


def sales_totals(base: DataFrame, key: str) -> DataFrame:
    """Sales of each entity sold, without its returns."""
    return base.groupBy(key).agg(*[e.alias(name) for name, e in _sales_sums().items()])


def _with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "margin_pct": safe_ratio("margin_amount", "net_revenue"),
            "avg_ticket": safe_ratio("net_revenue", "invoice_count"),
            "return_rate": safe_ratio("returned_amount", "gross_revenue"),
        }
    )


def _or_zero(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast(df.schema[column].dataType))


# --- reconciliation ---


def issued_revenue() -> Column:
    """Net revenue of the issued sales among all facts; for taking on the way to the stored facts."""
    return F.sum(F.when(F.col("invoice_status") == ISSUED, F.col("net_revenue")))


def revenue_differences(
    expected: Decimal, found: Mapping[str, Decimal | None], tolerance: float = TOLERANCE
) -> dict[str, Decimal]:
    """Of totals taken while tables were written, those that are off, and by how much. No rows add up to 0."""
    off = {name: (total or Decimal(0)) - expected for name, total in found.items()}
    return {name: by for name, by in off.items() if abs(by) > Decimal(str(tolerance))}


def revenue_check(base: DataFrame, tables: Mapping[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """Net revenue of each table against that of the base, all added up in one aggregate.

    Of the ranked tables give the totals, without names and ranks.
    """
    parts = base.select(F.lit("").alias("table_name"), "net_revenue")
    for name, table in tables.items():
        parts = parts.unionAll(table.select(F.lit(name), "net_revenue"))
    totals = parts.groupBy("table_name").agg(F.sum("net_revenue").alias("net_revenue"))
    # a handful of one-row totals: the base's is given to each table's row
    expected = totals.filter(F.col("table_name") == "").select(F.col("net_revenue").alias("base_net_revenue"))
    return (
        totals.filter(F.col("table_name") != "")
        .withColumn("base_net_revenue", expected.scalar())
        .withColumn("ok", F.abs(F.col("net_revenue") - F.col("base_net_revenue")) <= tolerance)
    )


def invoice_count_check(base: DataFrame, monthly: DataFrame) -> DataFrame:
    """Distinct invoices of the base against the sum of the monthly counts."""
    distinct = with_distinct_counts(base, [], {"base_invoices": "invoice_id"})
    distinct = distinct.select(F.coalesce("base_invoices", F.lit(0)).alias("base_invoices"))
    summed = monthly.agg(F.coalesce(F.sum("invoice_count"), F.lit(0)).alias("monthly_invoices"))
    return distinct.withColumn("monthly_invoices", summed.scalar()).withColumn(
        "ok", F.col("base_invoices") == F.col("monthly_invoices")
    )


def kpi_check(kpis: DataFrame, monthly: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Months whose net revenue differs between the company view and the regional view."""
    regional = monthly.groupBy("year_month").agg(F.sum("net_revenue").alias("regional_net_revenue"))
    joined = kpis.select("year_month", "net_revenue").join(regional, "year_month")
    off = F.abs(F.col("net_revenue") - F.col("regional_net_revenue")) > tolerance
    return joined.agg(F.count("*").alias("months"), F.count_if(off).alias("mismatched_months"))


def attainment_check(target_vs_actual: DataFrame) -> DataFrame:
    """Rows with a target but no attainment."""
    return target_vs_actual.agg(
        F.count_if("has_target").alias("rows_with_target"),
        F.count_if(F.col("has_target") & F.col("target_attainment").isNull()).alias("without_attainment"),
    )
