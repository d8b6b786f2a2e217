"""Registered queries against their SQL, and the plans they run by."""

import duckdb
import pytest
from check import TABLES, compare

from __spark_entry__ import entry, oracle_sql, queries
from workload.registry import KPI_COLUMNS, QUERIES, Model

SF = "/root/testdata/sf0.001"

# One of each kind; tools/check.py runs them all.
SAMPLE = [
    "incremental_extract",
    "last_watermark",
    "upsert_merge",
    "safe_ratio",
    "repair_encoding",
    "split_rejected",
    "deduplicate_latest",
    "silver_invoice_header",
    "silver_returns",
    "quarantine_reasons",
    "join_left_dims",
    "surrogate_key",
    "global_dense_rank",
    "dense_rank_text",
    "dense_rank_per_group",
    "key_bounds",
    "monthly_activity",
    "region_year_over_year",
    "dim_date",
    "fact_sales",
    "fact_returns",
    "orphan_keys",
    "product_ranking",
    "target_vs_actual",
    "commercial_kpis",
    "revenue_reconciliation",
    "region_month_over_month",
    "kpi_card_text",
    "top_returned_customers",
]


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, oracle, name):
    verdict, _ = compare(spark, oracle, SF, name)
    assert verdict.startswith("ok ")


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["incremental_extract"](spark, SF).select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_base_filters_on_status_before_the_item_join(spark):
    plan = plan_of(Model(spark, SF).staged("header").base_by_product.groupBy("product_key").count())
    assert "EqualTo(invoice_status,issued)" in plan and "month_name" not in plan


def test_stored_base_has_the_columns_that_are_read(spark):
    m = Model(spark, "no such folder")
    m.base = spark.createDataFrame([(1, "N1", 2)], "invoice_id long, invoice_number string, net_revenue long")
    m.stage_base("invoice_id", "net_revenue")
    assert m.base is m.base_by_region and m.base.columns == ["invoice_id", "net_revenue"]
    assert [tuple(r) for r in m.base.collect()] == [(1, 2)]


def test_kpis_store_the_columns_that_are_read(spark):
    m = Model(spark, SF).staged("items", "header", "returns", columns=KPI_COLUMNS)
    assert (m.items.columns, m.returns.columns) == (KPI_COLUMNS["items"], KPI_COLUMNS["returns"])
    whole = Model(spark, SF).staged("items", "header", "returns")
    assert sorted(m.commercial_kpis.collect()) == sorted(whole.commercial_kpis.collect())
