"""Silver: each bronze table checked, split, deduplicated and given standard names.

Foreign keys are looked up in the raw bronze tables, so a row is not rejected because its
parent was.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.joins import existence_flag
from tradeloom.operators.quality import (
    REASONS,
    add_reasons,
    deduplicate_latest,
    future_reason,
    null_reason,
    sign_reason,
    split_valid_rejected,
)
from tradeloom.operators.schema import CONTROL_COLUMNS, drop_control_columns, standardize_columns
from tradeloom.session import stage
from tradeloom.sources.layers import write_table
from tradeloom.sources.versions import LayerVersion

UPDATED_AT = "UpdatedAt"


@dataclass(frozen=True)
class TableRules:
    """What a valid row of one table looks like."""

    table: str
    bronze: str
    key: str
    not_null: tuple[str, ...]
    above_zero: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()
    not_future: tuple[str, ...] = ()
    # (column, bronze table, its key)
    foreign_keys: tuple[tuple[str, str, str], ...] = ()
    # (key, bronze table, its column): at least one row must refer back
    related: tuple[tuple[str, str, str], ...] = ()


# The business rules of the nine tables.
RULES = {
    rules.table: rules
    for rules in [
        TableRules("regions", "erp_regions", "RegionID", ("RegionID", "RegionCode")),
        TableRules(
            "payment_methods",
            "erp_payment_methods",
            "PaymentMethodID",
            ("PaymentMethodID", "PaymentMethodCode"),
        ),
        TableRules(
            "customers",
            "erp_customers",
            "CustomerID",
            ("CustomerID", "CustomerCode", "CustomerName"),
            foreign_keys=(("RegionID", "erp_regions", "RegionID"),),
        ),
        TableRules(
            "products",
            "erp_products",
            "ProductID",
            ("ProductID", "ProductCode", "ProductName"),
            above_zero=("UnitPrice",),
            not_negative=("UnitCost",),
        ),
        TableRules(
            "salespersons",
            "erp_salespersons",
            "SalespersonID",
            ("SalespersonID", "SalespersonCode", "SalespersonName"),
            foreign_keys=(("RegionID", "erp_regions", "RegionID"),),
        ),
        TableRules(
            "sales_invoice_header",
            "erp_sales_invoice_header",
            "InvoiceID",
            ("InvoiceID", "InvoiceNumber", "CustomerID", "IssueDate"),
            not_future=("IssueDate",),
            foreign_keys=(
                ("CustomerID", "erp_customers", "CustomerID"),
                ("SalespersonID", "erp_salespersons", "SalespersonID"),
                ("PaymentMethodID", "erp_payment_methods", "PaymentMethodID"),
            ),
            related=(("InvoiceID", "erp_sales_invoice_items", "InvoiceID"),),
        ),
        TableRules(
            "sales_invoice_items",
            "erp_sales_invoice_items",
            "InvoiceItemID",
            ("InvoiceItemID", "InvoiceID", "ProductID"),
            above_zero=("Quantity",),
            not_negative=("UnitPrice",),
            foreign_keys=(
                ("InvoiceID", "erp_sales_invoice_header", "InvoiceID"),
                ("ProductID", "erp_products", "ProductID"),
            ),
        ),
        TableRules(
            "sales_returns",
            "erp_sales_returns",
            "ReturnID",
            ("ReturnID", "InvoiceID", "InvoiceItemID", "ProductID", "CustomerID"),
            above_zero=("Quantity",),
            foreign_keys=(
                ("InvoiceID", "erp_sales_invoice_header", "InvoiceID"),
                ("InvoiceItemID", "erp_sales_invoice_items", "InvoiceItemID"),
                ("ProductID", "erp_products", "ProductID"),
                ("CustomerID", "erp_customers", "CustomerID"),
            ),
        ),
        TableRules(
            "sales_targets",
            "erp_sales_targets",
            "TargetID",
            ("TargetID", "SalespersonID", "RegionID"),
            above_zero=("TargetValue",),
            foreign_keys=(
                ("SalespersonID", "erp_salespersons", "SalespersonID"),
                ("RegionID", "erp_regions", "RegionID"),
            ),
        ),
    ]
}


def check_table(
    rules: TableRules, bronze: Mapping[str, DataFrame], as_of: datetime | Column | None = None
) -> DataFrame:
    """All checks of a table: one join per reference and one projection for the reasons."""
    rows = bronze[rules.bronze]
    df = rows
    reasons = [null_reason(c) for c in rules.not_null]
    reasons += [sign_reason(c) for c in rules.above_zero]
    reasons += [sign_reason(c, allow_zero=True) for c in rules.not_negative]
    reasons += [future_reason(c, as_of) for c in rules.not_future]
    lookups = [(*fk, f"{fk[0]}_not_found") for fk in rules.foreign_keys]
    lookups += [(*rel, f"no_related_records_via_{rel[2]}") for rel in rules.related]
    for number, (column, reference, reference_column, reason) in enumerate(lookups):
        flag = f"_found_{number}"
        df = existence_flag(df, column, bronze[reference], reference_column, flag)
        reasons.append(F.when(~F.col(flag), F.lit(reason)))
    return add_reasons(df, reasons).select(*rows.columns, REASONS)


def finish(rules: TableRules, valid: DataFrame, rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest valid row per key; standard names and no control columns on both sides.

    Rows of a key with equal time are settled by their other columns, so that a rerun
    keeps the same one.
    """
    others = [c for c in valid.columns if c not in (*CONTROL_COLUMNS, rules.key, UPDATED_AT)]
    latest = deduplicate_latest(valid, [rules.key], UPDATED_AT, others)
    return drop_control_columns(standardize_columns(latest)), drop_control_columns(standardize_columns(rejected))


def silver_table(
    rules: TableRules, bronze: Mapping[str, DataFrame], as_of: datetime | Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The valid rows and the quarantine of one table."""
    return finish(rules, *split_valid_rejected(check_table(rules, bronze, as_of)))


def write_silver_table(
    rules: TableRules, bronze: Mapping[str, DataFrame], version: LayerVersion, as_of: datetime | None = None
) -> dict[str, int]:
    """Check once, then write the valid table and its quarantine, which a clean run leaves empty."""
    checked = stage(check_table(rules, bronze, as_of), rules.table)
    valid, rejected = finish(rules, *split_valid_rejected(checked))
    return {
        "valid": write_table(valid, version.path(rules.table)),
        "rejected": write_table(rejected, version.path(f"{rules.table}_quarantine")),
    }


def quarantine_reasons(
    bronze: Mapping[str, DataFrame], tables: list[str] | None = None, as_of: datetime | Column | None = None
) -> DataFrame:
    """Rejected rows per table and reason; a row with two reasons counts under both."""
    counts = None
    for table in tables or list(RULES):
        rejected = check_table(RULES[table], bronze, as_of).filter(F.size(REASONS) > 0)
        per_reason = (
            rejected.select(F.lit(table).alias("table_name"), F.explode(REASONS).alias("reason"))
            .groupBy("table_name", "reason")
            .agg(F.count("*").alias("rejected_rows"))
        )
        counts = per_reason if counts is None else counts.unionByName(per_reason)
    return counts
