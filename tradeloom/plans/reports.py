"""Source reports: volume, integrity and dirty rows of the raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.amounts import line_amount
from tradeloom.functions.dates import moment


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = None
    for name, table in tables.items():
        row = table.agg(F.lit(name).alias("table_name"), F.count("*").alias("record_count"))
        counts = row if counts is None else counts.unionByName(row)
    return counts


def invoices_per_month(header: DataFrame) -> DataFrame:
    return header.groupBy(
        F.year("issue_date").alias("invoice_year"), F.month("issue_date").alias("invoice_month")
    ).agg(
        F.count("*").alias("invoice_count"),
        F.count_if(F.col("invoice_status") == "cancelled").alias("cancelled_count"),
    )


def invoices_without_items(header: DataFrame, items: DataFrame) -> DataFrame:
    return header.select("invoice_id", "invoice_number").join(items.select("invoice_id"), "invoice_id", "left_anti")


def dirty_items(items: DataFrame) -> DataFrame:
    return items.filter((F.col("quantity") <= 0) | (F.col("unit_price") < 0)).select(
        "invoice_item_id", "invoice_id", "product_id", "quantity", "unit_price"
    )


def future_invoices(header: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    return header.filter(F.col("issue_date") > moment(as_of)).select("invoice_id", "invoice_number", "issue_date")


def returns_by_product(returns: DataFrame, products: DataFrame) -> DataFrame:
    """Returns per product name, largest value first.

    The returns are summed per product before the names are looked up; products that
    share a name are then added together.
    """
    per_product = returns.groupBy("product_id").agg(
        F.count("*").alias("returns"),
        F.sum("quantity").alias("quantity"),
        F.sum(line_amount("quantity", "unit_value")).alias("value"),
    )
    return (
        per_product.join(products.select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg(
            F.sum("returns").alias("return_count"),
            F.sum("quantity").alias("total_quantity_returned"),
            F.sum("value").alias("total_value_returned"),
        )
        .orderBy(F.desc("total_value_returned"), F.asc("product_name"))
    )
