"""A full refresh of the stored layers, each from the tables of the layer before it.

A refresh reads one version of the layer before, writes a new version of its own beside
the one that readers use, and publishes it in one step when all checks are through.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.plans import diamond, gold
from tradeloom.plans.bronze import SOURCE_TABLES
from tradeloom.plans.silver import RULES, write_silver_table
from tradeloom.session import clear_staged
from tradeloom.sources.footers import stored_counts
from tradeloom.sources.jdbc import Database, publish_table
from tradeloom.sources.layers import (
    export_snapshot,
    read_layer,
    register_tables,
    require_ok,
    update_entries,
    write_observed,
)
from tradeloom.sources.versions import LayerVersion, current_version, drop_old_versions, next_version, publish_version

GOLD_TABLES = [
    "dim_region",
    "dim_payment_method",
    "dim_customer",
    "dim_product",
    "dim_salesperson",
    "dim_date",
    "fact_sales",
    "fact_returns",
    "fact_sales_targets",
]
# The silver table of which a gold table has every row.
GOLD_SOURCES = {
    "dim_region": "regions",
    "dim_payment_method": "payment_methods",
    "dim_customer": "customers",
    "dim_product": "products",
    "dim_salesperson": "salespersons",
    "fact_sales": "sales_invoice_items",
    "fact_returns": "sales_returns",
    "fact_sales_targets": "sales_targets",
}
DIAMOND_TABLES = [
    "monthly_sales",
    "product_ranking",
    "customer_ranking",
    "salesperson_performance",
    "target_vs_actual",
    "commercial_kpis",
]
LAYER_TABLES = {
    "bronze": [t.bronze for t in SOURCE_TABLES],
    "silver": list(RULES),
    "gold": GOLD_TABLES,
    "diamond": DIAMOND_TABLES,
}


# Totals taken while tables are written, and the executive tables that must agree on net revenue.
ISSUED_REVENUE = "issued_net_revenue"
REVENUE = "net_revenue"
RECONCILED = DIAMOND_TABLES[:4]


class CheckFailed(RuntimeError):
    """A refreshed layer does not reconcile with the one before it."""


class _Refresh:
    """One refresh of a layer: its tables go into a new version, which readers see from `publish` on."""

    def __init__(self, spark: SparkSession, root: str, layer: str) -> None:
        self.spark, self.root, self.layer = spark, root, layer
        self.version = next_version(spark, root, layer)
        self.totals: dict[str, dict[str, object]] = {}

    def store(self, name: str, df: DataFrame, totals: Mapping[str, Column] | None = None) -> DataFrame:
        """Write a table and take its totals on the way; returns the stored rows."""
        self.totals[name] = write_observed(df, self.version.path(name), totals)
        return self.version.read(self.spark, name)

    def publish(self) -> dict[str, int]:
        """Let readers see the new version; returns rows per table."""
        publish_version(self.spark, self.version, self.totals)
        update_entries(self.spark, self.root, self.layer, LAYER_TABLES[self.layer])
        drop_old_versions(self.spark, self.root, self.layer)
        clear_staged(self.spark)
        return {name: totals["rows"] for name, totals in self.totals.items()}


def refresh_silver(spark: SparkSession, root: str, as_of: datetime | None = None) -> dict[str, dict[str, int]]:
    """Check and write all nine tables; returns valid and rejected rows per table."""
    source = current_version(spark, root, "bronze")
    bronze = {t.bronze: source.read(spark, t.bronze) for t in SOURCE_TABLES}
    new = _Refresh(spark, root, "silver")
    rows = {table: write_silver_table(rules, bronze, new.version, as_of) for table, rules in RULES.items()}
    new.totals = {table: {"rows": counts["valid"], **counts} for table, counts in rows.items()}
    new.publish()
    return rows


def refresh_gold(spark: SparkSession, root: str, check: bool = True) -> dict[str, int]:
    """Write dimensions, then facts that read them back; returns rows per table.

    Readers see none of it before all checks have passed. Rows are compared as they were counted
    while both layers were written.
    """
    source = current_version(spark, root, "silver")
    silver = {table: source.read(spark, table) for table in RULES}
    new = _Refresh(spark, root, "gold")
    store = new.store
    header, items = silver["sales_invoice_header"], silver["sales_invoice_items"]
    returns, targets = silver["sales_returns"], silver["sales_targets"]
    region = store("dim_region", gold.dim_region(silver["regions"]))
    payment = store("dim_payment_method", gold.dim_payment_method(silver["payment_methods"]))
    customer = store("dim_customer", gold.dim_customer(silver["customers"], silver["regions"]))
    product = store("dim_product", gold.dim_product(silver["products"]))
    person = store("dim_salesperson", gold.dim_salesperson(silver["salespersons"], silver["regions"]))
    calendar = store("dim_date", gold.dim_date(header, returns, targets))
    dims = [customer, product, person, payment, region]
    sales = store("fact_sales", gold.fact_sales(items, header, returns, *dims, by_steps=True), {ISSUED_REVENUE: diamond.issued_revenue()})
    returned = store("fact_returns", gold.fact_returns(returns, header, *dims))
    aims = store("fact_sales_targets", gold.fact_sales_targets(targets, person, region))

    if check:
        written = {name: totals["rows"] for name, totals in new.totals.items()}
        before = stored_counts(spark, source, GOLD_SOURCES.values())
        off = {name: (before[t], written[name]) for name, t in GOLD_SOURCES.items() if before[t] != written[name]}
        if off:
            raise CheckFailed(f"row counts do not agree: {off}")
        facts = {"fact_sales": sales, "fact_returns": returned, "fact_sales_targets": aims}
        _require("calendar", gold.missing_dates(facts, calendar).filter("missing_dates > 0"))
    return new.publish()


def orphan_report(spark: SparkSession, root: str) -> DataFrame:
    """Rows with missing dimension keys; known ones belong to quarantined invoices."""
    quarantined = read_layer(spark, root, "silver", "sales_invoice_header_quarantine").select("invoice_id")
    stored = current_version(spark, root, "gold")
    facts = {name: stored.read(spark, name) for name in GOLD_TABLES[-3:]}
    return (
        gold.orphan_counts(facts["fact_sales"], "fact_sales", gold.SALES_KEYS, quarantined)
        .unionByName(gold.orphan_counts(facts["fact_returns"], "fact_returns", gold.RETURN_KEYS, quarantined))
        .unionByName(gold.orphan_counts(facts["fact_sales_targets"], "fact_sales_targets", gold.TARGET_KEYS))
    )


def refresh_diamond(spark: SparkSession, root: str, check: bool = True) -> dict[str, int]:
    """Write the six executive tables from the stored star schema; returns rows per table.

    Readers see none of it before all checks have passed. Net revenue is added up while the
    tables are written and compared with what was added up while the facts were, so that
    this check reads no table again.
    """
    source = current_version(spark, root, "gold")
    stars = {name: source.read(spark, name) for name in GOLD_TABLES}
    new = _Refresh(spark, root, "diamond")

    def store(name: str, build: Callable[..., DataFrame], *inputs: str) -> DataFrame:
        totals = {REVENUE: F.sum("net_revenue")} if name in RECONCILED else {}
        return new.store(name, build(base, *[stars[i] for i in inputs]), totals)

    base = diamond.sales_base(stars["fact_sales"])
    monthly = store("monthly_sales", diamond.monthly_sales, "dim_region")
    store("product_ranking", diamond.product_ranking, "fact_returns", "dim_product")
    store("customer_ranking", diamond.customer_ranking, "fact_returns", "dim_customer")
    store("salesperson_performance", diamond.salesperson_performance, "fact_returns", "dim_salesperson")
    targets = store(
        "target_vs_actual",
        diamond.target_vs_actual,
        "fact_sales_targets",
        "dim_salesperson",
        "dim_region",
    )
    kpis = store("commercial_kpis", diamond.commercial_kpis, "fact_returns", "fact_sales_targets")

    if check:
        found = {name: new.totals[name][REVENUE] for name in RECONCILED}
        off = diamond.revenue_differences(_issued_revenue(spark, source, stars["fact_sales"]), found)
        if off:
            raise CheckFailed(f"net revenue does not agree: {off}")
        _require("invoice counts", diamond.invoice_count_check(base, monthly).filter(~F.col("ok")))
        _require("monthly totals", diamond.kpi_check(kpis, monthly).filter("mismatched_months > 0"))
        _require("attainment", diamond.attainment_check(targets).filter("without_attainment > 0"))
    return new.publish()


def _issued_revenue(spark: SparkSession, source: LayerVersion, facts: DataFrame) -> Decimal:
    """As added up when the facts were written; facts that came without totals are read for it."""
    totals = source.totals(spark).get("fact_sales", {})
    if ISSUED_REVENUE in totals:
        return Decimal(totals[ISSUED_REVENUE] or 0)
    return facts.agg(diamond.issued_revenue()).first()[0] or Decimal(0)


def _require(what: str, failures: DataFrame) -> None:
    bad = failures.take(5)
    if bad:
        raise CheckFailed(f"{what} do not agree: {bad}")


# --- handing the executive tables on ---


def read_executive(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored executive table in the order in which it is presented."""
    return diamond.in_read_order(read_layer(spark, root, "diamond", table), table)


def export_diamond(spark: SparkSession, root: str, target: str) -> list[dict]:
    """A snapshot of every executive table, of one version, for other tools; fails if one differs from its source."""
    stored = current_version(spark, root, "diamond")
    results = [export_snapshot(stored.read(spark, t), f"{target.rstrip('/')}/{t}") for t in DIAMOND_TABLES]
    require_ok(results)
    return results


def publish_diamond(spark: SparkSession, root: str, database: Database, schema: str = "dbo") -> list[dict]:
    """Replace every executive table in a database; fails if a count differs there."""
    stored = current_version(spark, root, "diamond")
    results = [publish_table(stored.read(spark, t), database, f"{schema}.{t}") for t in DIAMOND_TABLES]
    require_ok(results)
    return results


def register_all(spark: SparkSession, root: str) -> list[str]:
    """Enter all layers' tables in the catalog for ad-hoc SQL."""
    return [name for layer, tables in LAYER_TABLES.items() for name in register_tables(spark, root, layer, tables)]
