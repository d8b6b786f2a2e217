"""The sales entities as projections of the given tables.

`Tables` has them clean, named as in the silver layer; its `bronze` has the nine source
tables with their own names, repeated versions and rows that break the rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import cached_property
from typing import Self

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.joins import lookup_join
from tradeloom.operators.quality import deduplicate_latest
from tradeloom.operators.schema import add_control_columns
from tradeloom.session import drop_garbage, stage

# Invoices dated later are "in the future".
AS_OF = datetime(2001, 7, 1)
FIRST_TARGET_MONTH = 2000 * 12 + 7
LAST_TARGET_MONTH = 2001 * 12 + 6

# The given tables' columns; a declared schema saves a job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def as_of() -> Column:
    return F.lit(str(AS_OF)).cast("timestamp_ntz")


def money(cents: str | Column) -> Column:
    """Whole cents to decimal(12,2)."""
    whole = F.expr(cents) if isinstance(cents, str) else cents
    return (whole.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(12,2)")


class BronzeTables(Mapping):
    """The source tables by name, each planned when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = with_control_columns(self._builders[name](), name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    # --- dimensions ---

    @cached_property
    def regions(self) -> DataFrame:
        return self.raw("region").selectExpr(
            "r_regionkey AS region_id",
            "concat('R', r_regionkey) AS region_code",
            "r_name AS region_name",
            "substring(r_name, 1, 2) AS state",
            "'World' AS country",
        )

    @cached_property
    def payment_methods(self) -> DataFrame:
        return (
            self.raw("orders")
            .select("o_orderpriority")
            .distinct()
            .selectExpr(
                "cast(substring(o_orderpriority, 1, 1) AS int) AS payment_method_id",
                "concat('PM', substring(o_orderpriority, 1, 1)) AS payment_method_code",
                "substring(o_orderpriority, 3) AS payment_method_name",
                "CASE WHEN substring(o_orderpriority, 1, 1) <= '2' THEN 'prepaid' ELSE 'credit' END AS payment_type",
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self._with_region("customer", "c_nationkey").selectExpr(
            "c_custkey AS customer_id",
            "concat('C', c_custkey) AS customer_code",
            "c_name AS customer_name",
            "concat('DOC', c_custkey) AS document",
            "concat('c', c_custkey, '@example.com') AS email",
            "concat('555-', c_custkey) AS phone",
            "c_mktsegment AS customer_segment",
            "n_regionkey AS region_id",
            "c_acctbal >= 0 AS is_active",
        )

    @cached_property
    def products(self) -> DataFrame:
        cents = "cast(round(p_retailprice * 100) AS bigint)"
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.expr("concat('P', p_partkey)").alias("product_code"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_name"),
            F.lit("UN").alias("unit_of_measure"),
            money(f"{cents} * 60 div 100").alias("unit_cost"),
            money(cents).alias("unit_price"),
            (F.col("p_size") <= 45).alias("is_active"),
        )

    @cached_property
    def salespersons(self) -> DataFrame:
        return self._with_region("supplier", "s_nationkey").selectExpr(
            "s_suppkey AS salesperson_id",
            "concat('S', s_suppkey) AS salesperson_code",
            "s_name AS salesperson_name",
            "n_regionkey AS region_id",
            "date_add(DATE '1990-01-01', cast(s_suppkey % 1000 AS int)) AS hire_date",
            "s_acctbal >= 0 AS is_active",
        )

    # --- transactions ---

    @cached_property
    def header(self) -> DataFrame:
        """Invoices with items that are not dated in the future; the seller is the smallest supplier."""
        return self._orders_with_seller("inner").filter(F.col("issue_date") <= as_of())

    @cached_property
    def invoices(self) -> DataFrame:
        """All orders as invoices; one without items has no seller."""
        return self._orders_with_seller("left")

    @cached_property
    def items(self) -> DataFrame:
        """The latest line per order and line number."""
        lines = deduplicate_latest(
            self.raw("lineitem"),
            ["l_orderkey", "l_linenumber"],
            "l_shipdate",
            ["l_partkey", "l_suppkey", "l_extendedprice"],
        )
        return self._as_items(lines)

    @cached_property
    def returns(self) -> DataFrame:
        """One or two partial returns of every line flagged as returned, if its invoice was issued."""
        invoices = self.header.filter(F.col("invoice_status") == "issued").select(
            "invoice_id", "customer_id", "issue_date"
        )
        lines = self.items.filter(F.col("return_flag") == "R")
        sold = lookup_join(lines, invoices, "invoice_id").filter(F.col("issue_date").isNotNull())
        return (
            sold.withColumn("part", F.explode(F.sequence(F.lit(1), 1 + F.col("item_sequence") % 2)))
            .withColumn("return_id", F.col("invoice_item_id") * 10 + F.col("part"))
            .select(
                "return_id",
                F.concat(F.lit("D"), F.col("return_id").cast("string")).alias("return_number"),
                "invoice_id",
                "invoice_item_id",
                "product_id",
                "customer_id",
                F.expr("issue_date + make_dt_interval(item_sequence + part)").alias("return_date"),
                F.expr("cast(greatest(1, cast(quantity AS bigint) div 8) AS decimal(12,2))").alias("quantity"),
                F.col("unit_price").alias("unit_value"),
                F.expr("CASE WHEN line_status = 'F' THEN 'defect' ELSE 'regret' END").alias("return_reason"),
            )
        )

    @cached_property
    def targets(self) -> DataFrame:
        """Twelve months of targets for every salesperson."""
        months = F.explode(F.sequence(F.lit(FIRST_TARGET_MONTH), F.lit(LAST_TARGET_MONTH)))
        return (
            self.salespersons
            .select("salesperson_id", "region_id", months.alias("m"))
            .selectExpr(
                f"salesperson_id * 100 + (m - {FIRST_TARGET_MONTH}) AS target_id",
                "salesperson_id",
                "region_id",
                "cast((m - 1) div 12 AS int) AS target_year",
                "cast((m - 1) % 12 + 1 AS int) AS target_month",
                "cast(15000 + (salesperson_id * 37 + ((m - 1) % 12 + 1) * 101) % 10000 AS decimal(14,2)) AS target_value",
            )
        )

    def staged(self, *names: str, columns: Mapping[str, list[str]] | None = None) -> Self:
        """Store the named entities, so that a query that uses them often reads them.

        Of an entity in `columns` only these are stored, and only what they need is shuffled before. Items and header come straight from the raw tables and are stored at the same time.
        """

        def store(name: str) -> None:
            entity = getattr(self, name)
            setattr(self, name, stage(entity.select(*(columns or {}).get(name, entity.columns)), name))

        independent = [n for n in names if n in ("items", "header")]
        if independent:
            with ThreadPoolExecutor(len(independent)) as threads:
                list(threads.map(store, independent))
        for name in names:
            if name not in independent:
                store(name)
        drop_garbage(self.spark)
        return self

    def _with_region(self, table: str, nation_key: str) -> DataFrame:
        nations = self.raw("nation").select(F.col("n_nationkey").alias(nation_key), "n_regionkey")
        return lookup_join(self.raw(table), nations, nation_key)

    def _orders_with_seller(self, how: str) -> DataFrame:
        sellers = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_suppkey").alias("salesperson_id"))
        )
        return (
            self.raw("orders")
            .join(sellers, "o_orderkey", how)
            .select(
                F.col("o_orderkey").alias("invoice_id"),
                F.expr("concat('N', o_orderkey)").alias("invoice_number"),
                F.lit("1").alias("invoice_series"),
                F.col("o_custkey").alias("customer_id"),
                "salesperson_id",
                F.expr("cast(substring(o_orderpriority, 1, 1) AS int)").alias("payment_method_id"),
                F.col("o_orderdate").alias("issue_date"),
                F.expr("CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'issued' END").alias("invoice_status"),
                money("CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 5000 ELSE 0 END").alias("discount_value"),
            )
        )

    def _as_items(self, lines: DataFrame) -> DataFrame:
        cents = "cast(round(l_extendedprice * 100) AS bigint)"
        percent = "cast(round(l_discount * 100) AS bigint)"
        return lines.select(
            F.expr("l_orderkey * 10 + l_linenumber").alias("invoice_item_id"),
            F.col("l_orderkey").alias("invoice_id"),
            F.col("l_linenumber").alias("item_sequence"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
            money(f"{cents} div cast(l_quantity AS bigint)").alias("unit_price"),
            money(f"{cents} * {percent} div 100").alias("discount_value"),
            F.col("l_shipdate").alias("updated_at"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
        )

    # --- source tables ---

    @cached_property
    def bronze(self) -> Mapping[str, DataFrame]:
        return BronzeTables(
            {
                "erp_regions": self._bronze_regions,
                "erp_payment_methods": self._bronze_payment_methods,
                "erp_customers": self._bronze_customers,
                "erp_products": self._bronze_products,
                "erp_salespersons": self._bronze_salespersons,
                "erp_sales_invoice_header": self._bronze_header,
                "erp_sales_invoice_items": self._bronze_items,
                "erp_sales_returns": self._bronze_returns,
                "erp_sales_targets": self._bronze_targets,
            }
        )

    def _bronze_regions(self) -> DataFrame:
        return _versions(self.regions, "region_id", 2).selectExpr(
            "region_id AS RegionID",
            "CASE WHEN region_id <> 4 THEN region_code END AS RegionCode",
            "concat(region_name, version_suffix) AS RegionName",
            "state AS State",
            "country AS Country",
            *_STAMPS,
        )

    def _bronze_payment_methods(self) -> DataFrame:
        return _versions(self.payment_methods, "payment_method_id", 3).selectExpr(
            "payment_method_id AS PaymentMethodID",
            "payment_method_code AS PaymentMethodCode",
            "concat(payment_method_name, version_suffix) AS PaymentMethodName",
            "payment_type AS PaymentType",
            *_STAMPS,
        )

    def _bronze_customers(self) -> DataFrame:
        return _versions(self.customers, "customer_id", 7).selectExpr(
            "customer_id AS CustomerID",
            "customer_code AS CustomerCode",
            "CASE WHEN customer_id % 37 <> 0 THEN concat(customer_name, version_suffix) END AS CustomerName",
            "document AS Document",
            "email AS Email",
            "phone AS Phone",
            "customer_segment AS CustomerSegment",
            "CASE WHEN customer_id % 31 = 0 THEN 99 WHEN customer_id % 29 <> 0 THEN region_id END AS RegionID",
            "is_active AS IsActive",
            *_STAMPS,
        )

    def _bronze_products(self) -> DataFrame:
        return _versions(self.products, "product_id", 11).selectExpr(
            "product_id AS ProductID",
            "CASE WHEN product_id % 41 <> 0 THEN product_code END AS ProductCode",
            "concat(product_name, version_suffix) AS ProductName",
            "category_name AS CategoryName",
            "unit_of_measure AS UnitOfMeasure",
            "cast(CASE WHEN product_id % 47 = 0 THEN -unit_cost ELSE unit_cost END AS decimal(12,2)) AS UnitCost",
            "cast(CASE WHEN product_id % 43 = 0 THEN 0 ELSE unit_price END AS decimal(12,2)) AS UnitPrice",
            "is_active AS IsActive",
            *_STAMPS,
        )

    def _bronze_salespersons(self) -> DataFrame:
        return _versions(self.salespersons, "salesperson_id", 5).selectExpr(
            "salesperson_id AS SalespersonID",
            "salesperson_code AS SalespersonCode",
            "CASE WHEN salesperson_id % 19 <> 3 THEN concat(salesperson_name, version_suffix) END AS SalespersonName",
            "CASE WHEN salesperson_id % 9 = 4 THEN 99 ELSE region_id END AS RegionID",
            "hire_date AS HireDate",
            "is_active AS IsActive",
            *_STAMPS,
        )

    def _bronze_header(self) -> DataFrame:
        return _versions(self._orders_with_seller("left"), "invoice_id", 13).selectExpr(
            "invoice_id AS InvoiceID",
            "CASE WHEN invoice_id % 113 <> 0 THEN invoice_number END AS InvoiceNumber",
            "invoice_series AS InvoiceSeries",
            "CASE WHEN invoice_id % 109 = 0 THEN -customer_id - 1 WHEN invoice_id % 127 <> 0 THEN customer_id END AS CustomerID",
            "salesperson_id AS SalespersonID",
            "payment_method_id AS PaymentMethodID",
            "CASE WHEN invoice_id % 131 <> 0 THEN issue_date END AS IssueDate",
            "CASE WHEN version = 1 THEN 'cancelled' ELSE invoice_status END AS InvoiceStatus",
            "discount_value AS DiscountValue",
            *_STAMPS,
        )

    def _bronze_items(self) -> DataFrame:
        return self._as_items(self.raw("lineitem")).selectExpr(
            "invoice_item_id AS InvoiceItemID",
            "CASE WHEN invoice_id % 101 = 0 THEN -invoice_id - 1 ELSE invoice_id END AS InvoiceID",
            "item_sequence AS ItemSequence",
            "CASE WHEN invoice_id % 79 = 0 THEN -product_id - 1 WHEN invoice_id % 83 <> 0 THEN product_id END AS ProductID",
            "cast(CASE WHEN invoice_id % 97 = 0 THEN -quantity WHEN invoice_id % 103 = 0 THEN 0 ELSE quantity END"
            " AS decimal(12,2)) AS Quantity",
            "cast(CASE WHEN invoice_id % 89 = 0 THEN -unit_price ELSE unit_price END AS decimal(12,2)) AS UnitPrice",
            "discount_value AS DiscountValue",
            "updated_at AS CreatedAt",
            "updated_at AS UpdatedAt",
        )

    def _bronze_returns(self) -> DataFrame:
        orders = self.raw("orders").selectExpr(
            "o_orderkey AS invoice_id", "o_custkey AS customer_id", "o_orderdate AS issue_date"
        )
        lines = self._as_items(self.raw("lineitem").filter("l_returnflag = 'R'"))
        return lookup_join(lines, orders, "invoice_id").selectExpr(
            "invoice_item_id * 10 + 1 AS ReturnID",
            "concat('D', invoice_item_id * 10 + 1) AS ReturnNumber",
            "invoice_id AS InvoiceID",
            "CASE WHEN invoice_id % 61 = 0 THEN -invoice_item_id - 1 ELSE invoice_item_id END AS InvoiceItemID",
            "CASE WHEN invoice_id % 67 = 0 THEN -product_id - 1 ELSE product_id END AS ProductID",
            "CASE WHEN invoice_id % 71 = 0 THEN -customer_id - 1 ELSE customer_id END AS CustomerID",
            "issue_date + make_dt_interval(item_sequence) AS ReturnDate",
            "cast(CASE WHEN invoice_id % 59 = 0 THEN 0 ELSE quantity END AS decimal(12,2)) AS Quantity",
            "unit_price AS UnitValue",
            "CASE WHEN line_status = 'F' THEN 'defect' ELSE 'regret' END AS ReturnReason",
            "updated_at AS CreatedAt",
            "updated_at AS UpdatedAt",
        )

    def _bronze_targets(self) -> DataFrame:
        return _versions(self.targets, "target_id", 10).selectExpr(
            "target_id AS TargetID",
            "CASE WHEN target_id % 17 = 3 THEN -1 ELSE salesperson_id END AS SalespersonID",
            "region_id AS RegionID",
            "target_year AS TargetYear",
            "target_month AS TargetMonth",
            "cast(CASE WHEN target_id % 13 = 5 THEN 0 ELSE target_value + version END AS decimal(14,2)) AS TargetValue",
            *_STAMPS,
        )


# The two times of a source row; a later version is a day younger.
_STAMPS = [
    "TIMESTAMP_NTZ '1995-01-01 00:00:00' AS CreatedAt",
    "TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(version) AS UpdatedAt",
]


def _versions(df: DataFrame, key: str, every: int) -> DataFrame:
    """Every so many keys get a second, later version of their row."""
    last = F.when(F.col(key) % every == 0, F.lit(1)).otherwise(F.lit(0))
    versions = df.withColumn("version", F.explode(F.sequence(F.lit(0), last)))
    return versions.withColumn("version_suffix", F.expr("CASE WHEN version = 1 THEN ' v1' ELSE '' END"))


def with_control_columns(df: DataFrame, table: str) -> DataFrame:
    stamp = F.lit("2001-07-01 05:15:00").cast("timestamp_ntz")
    return add_control_columns(df, "erp", table, "20010701051500-00000000", "full", stamp)
