"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.amounts import line_amount, safe_ratio
from tradeloom.functions.dates import date_key, month_index, month_start, month_text
from tradeloom.functions.text import misread_as_cp1252, repair_encoding
from tradeloom.operators.distinct import with_distinct_counts
from tradeloom.operators.joins import lookup_join
from tradeloom.operators.merge import last_watermark, rows_after, upsert
from tradeloom.operators.quality import (
    REASONS,
    check_foreign_key,
    check_has_related,
    check_not_future,
    check_not_null,
    check_positive,
    deduplicate_latest,
    split_valid_rejected,
)
from tradeloom.operators.ranking import dense_ranks, surrogate_key
from tradeloom.operators.schema import cast_columns, drop_control_columns, fill_nulls, snake_case, standardize_columns
from tradeloom.plans import diamond, gold, measures, reports
from tradeloom.plans.silver import RULES, quarantine_reasons, silver_table
from tradeloom.session import stage
from tradeloom.sources.footers import stored_bounds
from workload.tables import Tables, as_of, with_control_columns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MARK = datetime(2024, 1, 3)


class Model(Tables):
    """The gold and diamond tables over the given entities."""

    @cached_property
    def dim_region(self) -> DataFrame:
        return gold.dim_region(self.regions)

    @cached_property
    def dim_payment_method(self) -> DataFrame:
        return gold.dim_payment_method(self.payment_methods)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.customers, self.regions)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.products)

    @cached_property
    def dim_salesperson(self) -> DataFrame:
        return gold.dim_salesperson(self.salespersons, self.regions)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.header, self.returns, self.targets)

    def _dims(self) -> list[DataFrame]:
        return [self.dim_customer, self.dim_product, self.dim_salesperson, self.dim_payment_method, self.dim_region]

    def _business_items(self) -> DataFrame:
        return self.items.drop("return_flag", "line_status", "updated_at")

    @cached_property
    def lines(self) -> DataFrame:
        return gold.sales_lines(self._business_items(), self.header, self.returns, *self._dims())

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self._business_items(), self.header, self.returns, *self._dims())

    @cached_property
    def fact_returns(self) -> DataFrame:
        return gold.fact_returns(self.returns, self.header, *self._dims())

    @cached_property
    def fact_sales_targets(self) -> DataFrame:
        return gold.fact_sales_targets(self.targets, self.dim_salesperson, self.dim_region)

    @cached_property
    def base(self) -> DataFrame:
        """Issued sales with the keys that the executive tables group by."""
        dims = [self.dim_customer, self.dim_product, self.dim_salesperson, None, self.dim_region]
        return self._issued(dims)

    # Narrower bases, for tables that need fewer keys.
    @cached_property
    def base_by_region(self) -> DataFrame:
        return self._issued([None, self.dim_product, self.dim_salesperson, None, self.dim_region])

    @cached_property
    def base_by_product(self) -> DataFrame:
        return self._issued([None, self.dim_product, None, None, None])

    def _issued(self, dims: list[DataFrame | None]) -> DataFrame:
        return diamond.sales_base(gold.sales_lines(self._business_items(), self.header, self.returns, *dims))

    def stage_base(self, *columns: str) -> None:
        """Store the columns of the base that a query reads, for tables with and without customers."""
        self.base = self.base_by_region = stage(self.base.select(*columns), "base")

    def _returned(self, **wanted: DataFrame) -> DataFrame:
        """The returns with only the keys that are wanted."""
        names = ["customer", "product", "salesperson", "payment_method", "region"]
        return gold.return_lines(self.returns, self.header, *[wanted.get(n) for n in names])

    @cached_property
    def monthly_sales(self) -> DataFrame:
        return diamond.monthly_sales(self.base_by_region, self.dim_region)

    @cached_property
    def product_ranking(self) -> DataFrame:
        returned = self._returned(product=self.dim_product)
        return diamond.product_ranking(self.base_by_product, returned, self.dim_product)

    @cached_property
    def customer_ranking(self) -> DataFrame:
        returned = self._returned(customer=self.dim_customer)
        return diamond.customer_ranking(self.base, returned, self.dim_customer)

    @cached_property
    def salesperson_performance(self) -> DataFrame:
        returned = self._returned(salesperson=self.dim_salesperson)
        return diamond.salesperson_performance(self.base_by_region, returned, self.dim_salesperson)

    @cached_property
    def target_vs_actual(self) -> DataFrame:
        return diamond.target_vs_actual(
            self.base_by_region, self.fact_sales_targets, self.dim_salesperson, self.dim_region
        )

    @cached_property
    def commercial_kpis(self) -> DataFrame:
        return diamond.commercial_kpis(self.base, self._returned(), self.targets)


Build = Callable[[Model], DataFrame]


# What the company's months are made of: the columns that are read of stored entities.
KPI_COLUMNS = {
    "items": [
        "invoice_item_id", "invoice_id", "item_sequence", "product_id", "quantity", "unit_price", "discount_value", "return_flag", "line_status"
    ],
    "returns": ["return_id", "invoice_id", "invoice_item_id", "return_date", "quantity", "unit_value"],
}


def query(*staged: str, name: str | None = None, columns: dict[str, list[str]] | None = None) -> Callable[[Build], Build]:
    """Register a query; the entities given are stored first, with `columns` alone, as it reads them several times."""

    def register(build: Build) -> Build:
        QUERIES[name or build.__name__] = lambda spark, sf_dir: build(Model(spark, sf_dir).staged(*staged, columns=columns))
        return build

    return register


def with_reasons(df: DataFrame, *columns: str) -> DataFrame:
    names = [F.col(c).alias(snake_case(c)) for c in columns]
    return df.select(*names, F.concat_ws(", ", REASONS).alias("reasons"))


# --- sources, merge ---


@query()
def incremental_extract(m: Model) -> DataFrame:
    return rows_after(m.raw("events"), "ts", MARK).select("event_id", "ts", "user_id", "event_type")


@query(name="last_watermark")
def _last_watermark(m: Model) -> DataFrame:
    columns = {"events": "ts", "lineitem": "l_shipdate", "orders": "o_orderdate"}
    rows = None
    for table, column in columns.items():
        row = last_watermark(m.raw(table), column).select(F.lit(table).alias("table_name"), "last_watermark")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query()
def incremental_extract_date(m: Model) -> DataFrame:
    """Rows after a mark on a column of dates: whole days after the mark's."""
    days = m.raw("events").select("event_id", F.to_date("ts").alias("day"))
    return rows_after(days, "day", MARK)


@query()
def upsert_null_keys(m: Model) -> DataFrame:
    """Orders of which every seventh has lost its key, upserted by a later copy of the same."""
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("o_orderkey")
    target = m.raw("orders").select(key, "o_orderstatus", "o_orderdate")
    changed = rows_after(target, "o_orderdate", datetime(2000, 1, 1)).withColumn("o_orderstatus", F.lit("amended"))
    return upsert(target, changed, ["o_orderkey"])


@query()
def upsert_merge(m: Model) -> DataFrame:
    """Orders changed since a date are amended, and as many new ones arrive."""
    target = m.raw("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    recent = rows_after(target, "o_orderdate", datetime(2000, 1, 1))
    changed = recent.withColumn("o_orderstatus", F.lit("amended"))
    added = changed.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return upsert(target, changed.unionByName(added), ["o_orderkey"])


# --- schema ---


@query()
def add_control_columns(m: Model) -> DataFrame:
    return with_control_columns(m.raw("orders"), "orders")


@query(name="standardize_columns")
def _standardize_columns(m: Model) -> DataFrame:
    return drop_control_columns(standardize_columns(m.bronze["erp_sales_invoice_items"]))


@query(name="drop_control_columns")
def _drop_control_columns(m: Model) -> DataFrame:
    return drop_control_columns(m.bronze["erp_customers"])


@query(name="cast_columns")
def _cast_columns(m: Model) -> DataFrame:
    types = {
        "o_orderkey": "string",
        "o_totalprice": "decimal(14,2)",
        "o_orderpriority": "int",
        "o_orderdate": "date",
        "no_such_column": "int",
    }
    return cast_columns(m.raw("orders"), types)


@query()
def null_fill(m: Model) -> DataFrame:
    customers = m.bronze["erp_customers"].select("CustomerID", "CustomerName", "RegionID", "UpdatedAt")
    return standardize_columns(fill_nulls(customers, {"CustomerName": "unknown", "RegionID": 0}))


@query(name="safe_ratio")
def _safe_ratio(m: Model) -> DataFrame:
    """Returned units per kept unit of each order; NULL where everything came back."""
    came_back = F.col("return_flag") == "R"
    units = m.items.groupBy("invoice_id").agg(
        F.sum(F.when(came_back, F.col("quantity")).otherwise(0)).cast("decimal(28,2)").alias("returned_units"),
        F.sum(F.when(came_back, 0).otherwise(F.col("quantity"))).cast("decimal(28,2)").alias("kept_units"),
    )
    return units.withColumn("ratio", safe_ratio("returned_units", "kept_units"))


@query(name="repair_encoding")
def _repair_encoding(m: Model) -> DataFrame:
    """Whole texts, damaged where Windows-1252 can hold the damage, come back as they were."""
    damaged = F.coalesce(misread_as_cp1252("text"), F.col("text"))
    repaired = m.raw("documents").select("doc_id", repair_encoding(damaged).alias("text"))
    return repaired.select("doc_id", F.char_length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


# --- filters and source reports ---


@query("items", "header")
def sales_base(m: Model) -> DataFrame:
    return m.base.select("invoice_item_id", "invoice_status", "gross_revenue", "net_revenue", "margin_amount")


@query()
def dirty_items(m: Model) -> DataFrame:
    return reports.dirty_items(standardize_columns(m.bronze["erp_sales_invoice_items"]))


@query()
def future_invoices(m: Model) -> DataFrame:
    return reports.future_invoices(standardize_columns(m.bronze["erp_sales_invoice_header"]), as_of())


@query()
def table_counts(m: Model) -> DataFrame:
    return reports.table_counts(m.bronze)


# Every raw table with an integer key.
KEYED_TABLES = {
    "customer": "c_custkey",
    "documents": "doc_id",
    "events": "event_id",
    "lineitem": "l_orderkey",
    "orders": "o_orderkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
}


def _key_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bounds of the keys of the stored tables, from their footers: a row for each table."""
    rows = [(name, *stored_bounds(spark, f"{sf_dir}/{name}.parquet", key)) for name, key in KEYED_TABLES.items()]
    return spark.createDataFrame(rows, "table_name string, lowest bigint, highest bigint, rows bigint")


QUERIES["key_bounds"] = _key_bounds


@query()
def invoices_per_month(m: Model) -> DataFrame:
    return reports.invoices_per_month(standardize_columns(m.bronze["erp_sales_invoice_header"]))


@query()
def invoices_without_items(m: Model) -> DataFrame:
    header = standardize_columns(m.bronze["erp_sales_invoice_header"])
    return reports.invoices_without_items(header, standardize_columns(m.bronze["erp_sales_invoice_items"]))


@query()
def returns_by_product(m: Model) -> DataFrame:
    return reports.returns_by_product(m.returns, m.products)


# --- quality ---


@query(name="check_not_null")
def _check_not_null(m: Model) -> DataFrame:
    checked = check_not_null(m.bronze["erp_customers"], ["CustomerID", "CustomerName", "RegionID"])
    return with_reasons(checked, "CustomerID", "UpdatedAt")


@query(name="check_positive")
def _check_positive(m: Model) -> DataFrame:
    checked = check_positive(m.bronze["erp_sales_invoice_items"], "Quantity")
    return with_reasons(check_positive(checked, "UnitPrice", allow_zero=True), "InvoiceItemID", "Quantity", "UnitPrice")


@query(name="check_not_future")
def _check_not_future(m: Model) -> DataFrame:
    checked = check_not_future(m.bronze["erp_sales_invoice_header"], "IssueDate", as_of())
    return with_reasons(checked, "InvoiceID", "IssueDate")


@query(name="check_foreign_key")
def _check_foreign_key(m: Model) -> DataFrame:
    items = m.bronze["erp_sales_invoice_items"]
    checked = check_foreign_key(items, "ProductID", m.bronze["erp_products"], "ProductID")
    return with_reasons(checked, "InvoiceItemID", "ProductID")


@query(name="check_has_related")
def _check_has_related(m: Model) -> DataFrame:
    header, items = m.bronze["erp_sales_invoice_header"], m.bronze["erp_sales_invoice_items"]
    return with_reasons(check_has_related(header, "InvoiceID", items, "InvoiceID"), "InvoiceID", "UpdatedAt")


def _chain(m: Model) -> DataFrame:
    df = check_not_null(m.bronze["erp_sales_invoice_items"], ["InvoiceItemID", "InvoiceID", "ProductID"])
    df = check_positive(check_positive(df, "Quantity"), "UnitPrice", allow_zero=True)
    df = check_foreign_key(df, "InvoiceID", m.bronze["erp_sales_invoice_header"], "InvoiceID")
    return check_foreign_key(df, "ProductID", m.bronze["erp_products"], "ProductID")


@query()
def quality_chain(m: Model) -> DataFrame:
    return with_reasons(_chain(m), "InvoiceItemID", "ItemSequence", "UpdatedAt")


@query()
def split_valid(m: Model) -> DataFrame:
    valid, _ = split_valid_rejected(_chain(m))
    return standardize_columns(valid.select("InvoiceItemID", "InvoiceID", "ProductID", "Quantity", "UnitPrice"))


@query()
def split_rejected(m: Model) -> DataFrame:
    _, rejected = split_valid_rejected(_chain(m))
    columns = ["InvoiceItemID", "InvoiceID", "ProductID", "Quantity", "UnitPrice", "rejection_reason"]
    return standardize_columns(rejected.select(*columns))


@query(name="deduplicate_latest")
def _deduplicate_latest(m: Model) -> DataFrame:
    items = drop_control_columns(m.bronze["erp_sales_invoice_items"])
    ties = ["ProductID", "Quantity", "UnitPrice", "DiscountValue"]
    return standardize_columns(deduplicate_latest(items, ["InvoiceID", "ItemSequence"], "UpdatedAt", ties))


# --- silver ---

SILVER_NAMES = {
    "silver_regions": "regions",
    "silver_payment_methods": "payment_methods",
    "silver_customers": "customers",
    "silver_products": "products",
    "silver_salespersons": "salespersons",
    "silver_invoice_header": "sales_invoice_header",
    "silver_invoice_items": "sales_invoice_items",
    "silver_returns": "sales_returns",
    "silver_targets": "sales_targets",
}


def _silver(table: str) -> Query:
    return lambda spark, sf_dir: silver_table(RULES[table], Model(spark, sf_dir).bronze, as_of())[0]


for _name, _table in SILVER_NAMES.items():
    QUERIES[_name] = _silver(_table)


@query(name="quarantine_reasons")
def _quarantine_reasons(m: Model) -> DataFrame:
    return quarantine_reasons(m.bronze, as_of=as_of())


# --- joins and aggregates ---


@query("items")
def join_left_dims(m: Model) -> DataFrame:
    sellers = m.salespersons.select("salesperson_id", "salesperson_name", "region_id")
    invoices = m.header.select("invoice_id", "salesperson_id", "customer_id")
    rows = lookup_join(m.items.select("invoice_item_id", "invoice_id", "product_id"), invoices, "invoice_id")
    rows = lookup_join(rows, m.products.select("product_id", "product_name"), "product_id")
    rows = lookup_join(rows, m.customers.select("customer_id", "customer_segment"), "customer_id")
    rows = lookup_join(rows, sellers, "salesperson_id")
    rows = lookup_join(rows, m.regions.select("region_id", "region_name"), "region_id")
    return rows.select("invoice_item_id", "product_name", "customer_segment", "salesperson_name", "region_name")


@query()
def revenue_by_key(m: Model) -> DataFrame:
    return m.items.groupBy("product_id").agg(
        F.sum(line_amount("quantity", "unit_price")).alias("gross_revenue"),
        F.sum("discount_value").alias("discount_value"),
        F.sum("quantity").alias("units_sold"),
    )


@query()
def distinct_activity(m: Model) -> DataFrame:
    months = m.invoices.withColumn("year_month", F.date_format("issue_date", "yyyy-MM"))
    distinct = {"invoices": "invoice_id", "customers": "customer_id", "salespersons": "salesperson_id"}
    return with_distinct_counts(months, ["year_month"], distinct)


@query()
def distinct_keys(m: Model) -> DataFrame:
    return m.invoices.select("customer_id", "salesperson_id").distinct()


@query()
def calendar_bounds(m: Model) -> DataFrame:
    return gold.calendar_bounds(m.header, m.returns, m.targets)


@query()
def targets_by_month(m: Model) -> DataFrame:
    return diamond.targets_by_month(m.targets)


@query()
def scalar_dates(m: Model) -> DataFrame:
    invoices = m.invoices.select(
        "invoice_id",
        F.to_date("issue_date").alias("issue_day"),
        date_key("issue_date").alias("date_key"),
        F.date_format("issue_date", "yyyy-MM").alias("year_month"),
        F.date_format("issue_date", "MMMM").alias("month_name"),
        F.date_format("issue_date", "EEEE").alias("day_name"),
        F.year("issue_date").alias("year"),
        F.month("issue_date").alias("month"),
    )
    return invoices.withColumns(
        {
            "month_index": month_index("year", "month"),
            "month_text": month_text("year", "month"),
            "month_start": month_start("year", "month"),
            "seconds_since_2020": F.timestamp_diff(
                "SECOND", F.lit("2020-01-01").cast("timestamp_ntz"), F.col("issue_day").cast("timestamp_ntz")
            ),
        }
    )


# --- numbering and ranking ---


@query(name="surrogate_key")
def _surrogate_key(m: Model) -> DataFrame:
    return surrogate_key(m.invoices.select("invoice_id"), "invoice_key", "invoice_id", id_bits=12)


@query()
def surrogate_key_text(m: Model) -> DataFrame:
    """Invoices numbered by their number, which is text."""
    return surrogate_key(m.invoices.select("invoice_number"), "invoice_key", "invoice_number")


@query()
def global_dense_rank(m: Model) -> DataFrame:
    totals = m.items.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"), F.max("unit_price").alias("top_price")
    )
    ranks = {"rank_units_sold": "units_sold", "rank_top_price": "top_price"}
    return dense_ranks(totals, ranks)


@query()
def dense_rank_text(m: Model) -> DataFrame:
    """Customers by segment and by name, both of which are text: the last in order comes first."""
    rows = m.customers.select("customer_id", "customer_segment", "customer_name")
    return dense_ranks(rows, {"rank_segment": "customer_segment", "rank_name": "customer_name"})


@query()
def dense_rank_per_group(m: Model) -> DataFrame:
    sold = m.items.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    names = m.products.select("product_id", "category_name")
    rows = lookup_join(sold, names, "product_id")
    return dense_ranks(rows, {"rank_in_category": "units_sold"}, within=["category_name"])


# --- gold ---


def _gold(name: str, *staged: str, columns: dict[str, list[str]] | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: getattr(Model(spark, sf_dir).staged(*staged, columns=columns), name)


for _name in ("dim_region", "dim_payment_method", "dim_customer", "dim_product", "dim_salesperson"):
    _gold(_name)
_gold("dim_date")
_gold("fact_returns", "items", "header", "returns")
_gold("fact_sales_targets")


@query("items", "header")
def fact_sales(m: Model) -> DataFrame:
    return gold.fact_sales(m._business_items(), m.header, m.returns, *m._dims(), by_steps=True)


@query("items", "header")
def discount_allocation(m: Model) -> DataFrame:
    rows = gold.allocate_discounts(m.items.select("invoice_item_id", "invoice_id", "quantity", "unit_price"), m.header)
    return rows.select("invoice_item_id", "invoice_id", "header_discount_allocated")


@query("items", "header")
def returns_per_item(m: Model) -> DataFrame:
    return gold.returns_per_item(m.returns)


@query("items", "header", "returns")
def gold_count_check(m: Model) -> DataFrame:
    return gold.count_check(
        {
            "dim_region": (m.regions, m.dim_region),
            "dim_payment_method": (m.payment_methods, m.dim_payment_method),
            "dim_customer": (m.customers, m.dim_customer),
            "dim_product": (m.products, m.dim_product),
            "dim_salesperson": (m.salespersons, m.dim_salesperson),
            "fact_sales": (m.items, m.fact_sales),
            "fact_returns": (m.returns, m.fact_returns),
            "fact_sales_targets": (m.targets, m.fact_sales_targets),
        }
    )


@query("items", "header", "returns")
def orphan_keys(m: Model) -> DataFrame:
    """Items without an invoice are known orphans where the order is dated in the future."""
    future = m.raw("orders").filter(F.col("o_orderdate") > as_of()).select(F.col("o_orderkey").alias("invoice_id"))
    return (
        gold.orphan_counts(m.lines, "fact_sales", gold.SALES_KEYS, future)
        .unionByName(gold.orphan_counts(m.fact_returns, "fact_returns", gold.RETURN_KEYS))
        .unionByName(gold.orphan_counts(m.fact_sales_targets, "fact_sales_targets", gold.TARGET_KEYS))
    )


@query("items", "header", "returns")
def date_key_coverage(m: Model) -> DataFrame:
    facts = {
        "fact_sales": m.lines,
        "fact_returns": m.fact_returns,
        "fact_sales_targets": m.fact_sales_targets,
    }
    return gold.missing_dates(facts, m.dim_date)


# --- diamond ---

DIAMOND = [
    "monthly_sales",
    "product_ranking",
    "customer_ranking",
    "salesperson_performance",
    "target_vs_actual",
    "commercial_kpis",
]
for _name in DIAMOND:
    _gold(_name, "items", "header", "returns", columns=KPI_COLUMNS if _name == "commercial_kpis" else None)


@query("items", "header", "base")
def revenue_reconciliation(m: Model) -> DataFrame:
    # each table's own sums over the sales; its names, returns and ranks do not enter them
    m.base_by_region = m.base
    tables = {
        "monthly_sales": m.monthly_sales,
        "product_ranking": diamond.sales_totals(m.base, "product_key"),
        "customer_ranking": diamond.sales_totals(m.base, "customer_key"),
        "salesperson_performance": diamond.sales_totals(m.base, "salesperson_key"),
    }
    return diamond.revenue_check(m.base, tables)


@query("items", "header")
def monthly_activity(m: Model) -> DataFrame:
    return diamond.monthly_activity(m.base)


@query("items", "header", "returns", "base")
def invoice_count_check(m: Model) -> DataFrame:
    m.base_by_region = m.base
    return diamond.invoice_count_check(m.base, m.monthly_sales)


@query("items", "header", "returns")
def kpi_vs_monthly_check(m: Model) -> DataFrame:
    # what the two tables are made of
    keys = ["date_key", "region_key", "invoice_id", "customer_key", "salesperson_key"]
    amounts = ["quantity", "gross_revenue", "net_revenue", "margin_amount", "discount_amount", "returned_amount"]
    m.stage_base(*keys, *amounts)
    return diamond.kpi_check(m.commercial_kpis, m.monthly_sales)


@query("items", "header", "returns")
def attainment_check(m: Model) -> DataFrame:
    return diamond.attainment_check(m.target_vs_actual)


# --- measures over the executive tables ---


@query("items", "header", "returns", "commercial_kpis", columns=KPI_COLUMNS)
def kpi_month_over_month(m: Model) -> DataFrame:
    return measures.month_over_month(m.commercial_kpis)


@query("items", "header", "returns", "commercial_kpis", columns=KPI_COLUMNS)
def kpi_year_over_year(m: Model) -> DataFrame:
    return measures.year_over_year(m.commercial_kpis)


@query("items", "header", "returns", "monthly_sales")
def region_month_over_month(m: Model) -> DataFrame:
    return measures.region_month_over_month(m.monthly_sales)


@query("items", "header", "returns", "monthly_sales")
def region_year_over_year(m: Model) -> DataFrame:
    return measures.region_year_over_year(m.monthly_sales)


@query("items", "header", "returns")
def attainment_weighted(m: Model) -> DataFrame:
    return measures.attainment(m.target_vs_actual, ["region_name", "target_year"])


@query("items", "header", "returns", "target_vs_actual")
def attainment_change_pp(m: Model) -> DataFrame:
    return measures.attainment_change(m.target_vs_actual)


@query("items", "header", "returns", "commercial_kpis", columns=KPI_COLUMNS)
def kpi_card_text(m: Model) -> DataFrame:
    return measures.kpi_cards(m.commercial_kpis)


@query("items", "header", "returns", "product_ranking")
def dynamic_rank_product(m: Model) -> DataFrame:
    ranked = measures.rank_selected(m.product_ranking, {"category_name": ["PROMO", "ECONOMY"]}, "dynamic_rank")
    return ranked.select("product_key", "category_name", "net_revenue", "rank_net_revenue", "dynamic_rank")


@query("items", "header", "returns", "customer_ranking")
def dynamic_rank_customer(m: Model) -> DataFrame:
    ranked = measures.rank_selected(m.customer_ranking, {"customer_segment": ["FURNITURE"]}, "dynamic_rank")
    return ranked.select("customer_key", "customer_segment", "net_revenue", "rank_net_revenue", "dynamic_rank")


@query("items", "header", "returns", "salesperson_performance")
def dynamic_rank_salesperson(m: Model) -> DataFrame:
    ranked = measures.rank_selected(m.salesperson_performance, {"region_name": ["ASIA", "EUROPE"]}, "dynamic_rank")
    return ranked.select("salesperson_key", "region_name", "net_revenue", "rank_net_revenue", "dynamic_rank")


def _top(name: str, entity: str, metric: str, label: str) -> None:
    """The ten first of the totals alone; names are looked up for those ten."""
    key = f"{entity}_key"

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = Model(spark, sf_dir).staged("items", "header", "returns")
        dimension = getattr(m, f"dim_{entity}")
        base = {"product": "base_by_product", "customer": "base", "salesperson": "base_by_region"}[entity]
        totals = diamond.entity_totals(getattr(m, base), m._returned(**{entity: dimension}), key)
        first = measures.top(totals.select(key, metric), metric, key)
        return first.join(dimension.select(key, label), key, "left").select(key, label, metric)

    QUERIES[name] = build


_top("top_products", "product", "net_revenue", "product_name")
_top("top_returned_products", "product", "returned_amount", "product_name")
_top("top_customers", "customer", "net_revenue", "customer_name")
_top("top_returned_customers", "customer", "returned_amount", "customer_name")
_top("top_salespersons", "salesperson", "net_revenue", "salesperson_name")
_top("top_returned_salespersons", "salesperson", "returned_amount", "salesperson_name")
