"""Ingest: full or incremental load of each source table into the bronze layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tradeloom.functions.text import repair_encoding
from tradeloom.operators.schema import add_control_columns, repair_text_columns
from tradeloom.session import stage
from tradeloom.sources.jdbc import Database, Split, find_split, read_incremental
from tradeloom.sources.layers import (
    stored_watermark,
    table_or_none,
    table_path,
    watermark_of,
    write_table,
    write_upsert,
)
from tradeloom.sources.ledger import Batch, Ledger

WATERMARK = "UpdatedAt"


@dataclass(frozen=True)
class SourceTable:
    """A source table; without a key it is loaded in full each time."""

    source: str
    bronze: str
    key: str | None = None

    @property
    def load_type(self) -> str:
        return "incremental" if self.key else "full"


# Fixed names: the nine source tables and how each is loaded.
SOURCE_TABLES = [
    SourceTable("erp.Regions", "erp_regions"),
    SourceTable("erp.PaymentMethods", "erp_payment_methods"),
    SourceTable("erp.Customers", "erp_customers", "CustomerID"),
    SourceTable("erp.Products", "erp_products", "ProductID"),
    SourceTable("erp.Salespersons", "erp_salespersons", "SalespersonID"),
    SourceTable("erp.SalesInvoiceHeader", "erp_sales_invoice_header", "InvoiceID"),
    SourceTable("erp.SalesInvoiceItems", "erp_sales_invoice_items", "InvoiceItemID"),
    SourceTable("erp.SalesReturns", "erp_sales_returns", "ReturnID"),
    SourceTable("erp.SalesTargets", "erp_sales_targets", "TargetID"),
]

# Fixed names: the text columns whose encoding is repaired, per source table.
TEXT_COLUMNS = {
    "erp.Regions": ["RegionName"],
    "erp.Customers": ["CustomerName"],
    "erp.Products": ["ProductName", "CategoryName"],
    "erp.Salespersons": ["SalespersonName"],
    "erp.PaymentMethods": ["PaymentMethodName"],
    "erp.SalesReturns": ["ReturnReason"],
}


def repair_source(df: DataFrame, source: str, repaired_at: datetime | None = None) -> DataFrame:
    """A source table with its misread texts repaired; changed rows count as updated.

    For writing back to the source, where the next increment picks the changed rows up.
    """
    columns = TEXT_COLUMNS.get(source, [])
    return repair_text_columns(df, columns, WATERMARK, repaired_at) if columns else df


def repaired_rows(df: DataFrame, source: str) -> DataFrame:
    """Ingested rows with misread texts repaired.

    Their time of change stays the source's: moved ahead, it would hide later changes from the next increment.
    """
    return df.withColumns({c: repair_encoding(c) for c in TEXT_COLUMNS.get(source, [])})


# Given a source table and a high-water mark, the rows after the mark (all, if None).
Extract = Callable[[SourceTable, datetime | None], DataFrame]


def database_extract(spark: SparkSession, database: Database, splits: Mapping[str, Split] | None = None) -> Extract:
    """Extract through JDBC. A table with a key is divided by it, into as many reads as its rows ask for.

    `splits` says per source table how to divide it instead.
    """

    def extract(table: SourceTable, mark: datetime | None) -> DataFrame:
        split = (splits or {}).get(table.source)
        if split is None and table.key:
            split = find_split(spark, database, table.source, table.key, WATERMARK, mark)
        return read_incremental(spark, database, table.source, WATERMARK, mark, split)

    return extract


def ingest_table(
    spark: SparkSession, table: SourceTable, extract: Extract, root: str, batch_id: str, source_system: str
) -> int:
    """Load one table, its texts repaired, and return the number of rows taken from the source.

    A batch may be repeated: one that was finished is recognised and changes nothing, one that died
    halfway starts from the same mark again.
    """
    path = table_path(root, "bronze", table.bronze)
    ledger = Ledger(spark, root, table.bronze)
    finished = ledger.find(batch_id)
    if finished:
        return finished.rows
    mark = _mark(spark, path, ledger) if table.key else None
    rows = add_control_columns(repaired_rows(extract(table, mark), table.source), source_system, table.source, batch_id, table.load_type)
    if not table.key:
        ledger.add(Batch(batch_id, table.load_type, loaded := write_table(rows, path)))
        return loaded
    # the source is asked once; the checks and the merge read the copy
    fresh = stage(rows, table.bronze)
    if fresh.isEmpty():
        ledger.add(Batch(batch_id, table.load_type, 0, mark))
        return 0
    loaded = write_upsert(spark, fresh, path, table.key)
    marks = [m for m in (mark, watermark_of(fresh, WATERMARK)) if m is not None]
    ledger.add(Batch(batch_id, table.load_type, loaded, max(marks, default=None)))
    return loaded


def _mark(spark: SparkSession, path: str, ledger: Ledger) -> datetime | None:
    """Where the next batch continues: as the ledger says, or the table where it says nothing.

    A table that is gone is loaded from the start.
    """
    last = ledger.last()
    if last is None:
        return stored_watermark(spark, path, WATERMARK)
    return last.mark if table_or_none(spark, path) is not None else None


def ingest_all(
    spark: SparkSession, extract: Extract, root: str, batch_id: str, source_system: str
) -> dict[str, int]:
    return {t.bronze: ingest_table(spark, t, extract, root, batch_id, source_system) for t in SOURCE_TABLES}
