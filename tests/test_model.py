import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradeloom import session
from tradeloom.functions.amounts import allocate, safe_ratio
from tradeloom.functions.text import kpi_card
from tradeloom.plans import diamond, gold, measures, reports

ITEM = "invoice_item_id bigint, invoice_id bigint, quantity decimal(12,2), unit_price decimal(12,2)"
HEADER = "invoice_id bigint, discount_value decimal(12,2)"
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def d(text):
    return Decimal(text)


def test_allocation(spark):
    items = spark.createDataFrame(
        [(1, 1, d("3"), d("10.00")), (2, 1, d("7"), d("9.99")), (3, 2, d("1"), d("0")), (4, 3, d("1"), d("5"))], ITEM
    )
    header = spark.createDataFrame([(1, d("2.50")), (2, d("9.00"))], HEADER)
    shares = {r[0]: r[-1] for r in gold.allocate_discounts(items, header).collect()}
    assert shares == {1: d("0.750525"), 2: d("1.749475"), 3: 0, 4: 0}


def test_allocation_for_a_hot_invoice(spark, rows):
    items = spark.range(200).selectExpr("id AS invoice_item_id", "CASE WHEN id < 150 THEN 1L ELSE id END AS invoice_id",
                                        "cast(1 + id % 3 AS decimal(12,2)) AS quantity",
                                        "cast(2.50 AS decimal(12,2)) AS unit_price")
    header = spark.range(200).selectExpr("id AS invoice_id", "cast(5 AS decimal(12,2)) AS discount_value")
    result = gold.allocate_discounts(items, header)
    sums = {r[0]: r[1] for r in result.groupBy("invoice_id").agg({"header_discount_allocated": "sum"}).collect()}
    assert len(sums) == 51 and all(abs(v - 5) < d("0.0001") for v in sums.values())


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(1, 500), st.integers(0, 99_999)), min_size=1, max_size=12),
    st.integers(0, 1_000_000),
)
def test_allocation_adds_up(spark, lines, cents):
    data = [(i, 1, d(q), d(p) / 100) for i, (q, p) in enumerate(lines)]
    items = spark.createDataFrame(data, ITEM)
    header = spark.createDataFrame([(1, d(cents) / 100)], HEADER)
    shares = [r[-1] for r in gold.allocate_discounts(items, header).collect()]
    expected = d(cents) / 100 if any(p for _, p in lines) else 0
    assert abs(sum(shares) - expected) <= d("0.000001") * len(lines)


def test_ratio_is_null_without_a_denominator(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, 0D), (1D, NULL), (NULL, 2D), (1D, 4D), (0D, 0D) AS t(n, d)")
    assert [r[0] for r in df.select(safe_ratio("n", "d")).collect()] == [None, None, None, 0.25, None]
    assert df.select(allocate("n", "n", "d")).dtypes[0][1] == "decimal(18,6)"


def sources(spark):
    """Two issued invoices, a cancelled one, and an item whose invoice is missing."""
    regions = spark.sql("SELECT * FROM VALUES (7, 'R7', 'North', 'N', 'W'), (9, 'R9', 'South', 'S', 'W')"
                        " AS t(region_id, region_code, region_name, state, country)")
    payment = spark.sql("SELECT 1 AS payment_method_id, 'P' AS payment_method_code, 'cash' AS payment_method_name,"
                        " 'x' AS payment_type")
    customers = spark.sql("SELECT id AS customer_id, concat('C', id) AS customer_code, 'n' AS customer_name,"
                          " 'd' AS document, 'e' AS email, 'p' AS phone, 's' AS customer_segment, 9 AS region_id,"
                          " true AS is_active FROM range(10, 12)")
    products = spark.sql("SELECT id AS product_id, concat('P', id) AS product_code, concat('p', id) AS product_name,"
                         " 'c' AS category_name, 'UN' AS unit_of_measure, cast(4 AS decimal(12,2)) AS unit_cost,"
                         " cast(10 AS decimal(12,2)) AS unit_price, true AS is_active FROM range(20, 23)")
    people = spark.sql("SELECT id AS salesperson_id, concat('S', id) AS salesperson_code, concat('s', id) AS"
                       " salesperson_name, 7 AS region_id, DATE '2020-01-01' AS hire_date, true AS is_active"
                       " FROM range(30, 32)")
    header = spark.createDataFrame(
        [
            (1, "N1", "1", 10, 30, 1, datetime(2024, 1, 5), "issued", d("5.00")),
            (2, "N2", "1", 11, 30, 1, datetime(2024, 3, 5), "issued", d("0.00")),
            (3, "N3", "1", 10, 31, 1, datetime(2024, 3, 6), "cancelled", d("0.00")),
        ],
        "invoice_id bigint, invoice_number string, invoice_series string, customer_id bigint, salesperson_id bigint,"
        " payment_method_id int, issue_date timestamp_ntz, invoice_status string, discount_value decimal(12,2)",
    )
    items = spark.createDataFrame(
        [
            (11, 1, 1, 20, d("2"), d("10"), d("1.00")),
            (12, 1, 2, 21, d("3"), d("10"), d("0")),
            (21, 2, 1, 20, d("1"), d("10"), d("0")),
            (31, 3, 1, 20, d("9"), d("10"), d("0")),
            (91, 99, 1, 20, d("1"), d("10"), d("0")),
        ],
        "invoice_item_id bigint, invoice_id bigint, item_sequence int, product_id bigint, quantity decimal(12,2),"
        " unit_price decimal(12,2), discount_value decimal(12,2)",
    )
    returns = spark.createDataFrame(
        [
            (1, "D1", 1, 12, 21, 10, datetime(2024, 3, 9), d("1"), d("10"), "broken"),
            (2, "D2", 1, 12, 21, 10, datetime(2024, 12, 9), d("1"), d("10"), None),
            (3, "D3", 3, 31, 22, 10, datetime(2024, 3, 9), d("1"), d("10"), None),
        ],
        "return_id bigint, return_number string, invoice_id bigint, invoice_item_id bigint, product_id bigint,"
        " customer_id bigint, return_date timestamp_ntz, quantity decimal(12,2), unit_value decimal(12,2),"
        " return_reason string",
    )
    targets = spark.createDataFrame(
        [(1, 30, 7, 2024, 1, d("88.00")), (2, 30, 7, 2024, 2, d("50.00")), (3, 31, 7, 2024, 3, d("0.00"))],
        "target_id bigint, salesperson_id bigint, region_id int, target_year int, target_month int,"
        " target_value decimal(14,2)",
    )
    dims = [
        gold.dim_customer(customers, regions),
        gold.dim_product(products),
        gold.dim_salesperson(people, regions),
        gold.dim_payment_method(payment),
        gold.dim_region(regions),
    ]
    return header, items, returns, targets, dims


@pytest.fixture(scope="module")
def model(spark):
    header, items, returns, targets, dims = sources(spark)
    sales = gold.fact_sales(items, header, returns, *dims).cache()
    return {
        "header": header,
        "items": items,
        "returns": returns,
        "targets": targets,
        "customer": dims[0],
        "product": dims[1],
        "person": dims[2],
        "region": dims[4],
        "sales": sales,
        "base": diamond.sales_base(sales),
        "returned": gold.fact_returns(returns, header, *dims),
        "aims": gold.fact_sales_targets(targets, dims[2], dims[4]),
        "date": gold.dim_date(header, returns, targets),
    }


def test_fact_sales_measures(model):
    facts = {r.invoice_item_id: r for r in model["sales"].collect()}
    assert [facts[i].sales_key for i in (11, 12, 21, 31, 91)] == [1, 2, 3, 4, 5]
    first, second = facts[11], facts[12]
    assert (first.header_discount_allocated, second.header_discount_allocated) == (d("2"), d("3"))
    assert (first.gross_revenue, first.discount_amount, first.net_revenue) == (d("20"), d("3"), d("17"))
    assert (first.total_cost, first.margin_amount, first.margin_pct) == (d("8"), d("9"), 9 / 17)
    assert (second.returned_amount, second.returned_quantity, second.net_revenue) == (d("20"), d("2"), d("7"))
    assert first.date_key == 20240105 and first.customer_key == 1 and first.salesperson_key == 1


def test_sales_by_steps_hold_one_shuffle_of_the_items_at_a_time(spark, rows, tmp_path, monkeypatch):
    header, items, returns, _, dims = sources(spark)
    odd = [(None, 2, 2, 20, d("1"), d("10"), d("0")), (12, 1, 3, None, d("4"), d("10"), d("0"))]  # no id, and an id twice
    items = items.unionByName(spark.createDataFrame(odd, items.schema))
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    stored = gold.fact_sales(items, header, returns, *dims, by_steps=True)
    expected = rows(gold.fact_sales(items, header, returns, *dims).drop("sales_key"))
    assert rows(stored.drop("sales_key")) == expected and len(expected) == 7
    assert sorted(r.sales_key for r in stored.collect()) == list(range(1, 8))
    # the copies that nothing reads any more are gone, and what is left to do is one join of two stored tables
    assert sorted(p.name.split("-")[0] for p in tmp_path.glob("staged/*/*")) == ["invoices", "priced"]
    plan = stored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "Aggregate" not in plan and "Window" not in plan


def test_invoices_are_joined_last(spark):
    # what is read from the invoice would otherwise be shuffled again for the returns and for the products
    header, items, returns, _, dims = sources(spark)
    plan = gold.sales_lines(items, header, returns, *dims)._jdf.queryExecution().optimizedPlan().toString()
    on_the_way = re.findall(r"^[: ]*(?:\+- )?Join LeftOuter, \((\w+)#", plan, flags=re.MULTILINE)
    assert on_the_way[:3] == ["invoice_id", "product_id", "invoice_item_id"]


def test_region_is_the_salespersons(model):
    # customers live in region 9 (key 2), salespersons work in region 7 (key 1)
    assert {r.region_key for r in model["sales"].filter("invoice_id <> 99").collect()} == {1}


def test_items_without_invoice_stay_with_null_keys(model):
    orphan = model["sales"].filter("invoice_item_id = 91").first()
    assert orphan.customer_key is orphan.date_key is orphan.region_key is orphan.invoice_status is None
    assert orphan.product_key == 1 and orphan.net_revenue == d("10")
    row = gold.orphan_counts(model["sales"], "f", gold.SALES_KEYS).first()
    assert (row.known_orphans, row.unexpected_orphans) == (0, 1)
    known = model["sales"].filter("invoice_id = 99").select("invoice_id")
    row = gold.orphan_counts(model["sales"], "f", gold.SALES_KEYS, known).first()
    assert (row.known_orphans, row.unexpected_orphans) == (1, 0)


def test_calendar_covers_whole_months_up_to_december(model, rows):
    days = sorted(d for (d,) in rows(model["date"], "full_date"))
    assert (days[0], days[-1], len(days)) == (date(2024, 1, 1), date(2024, 12, 31), 366)
    sunday = model["date"].filter("date_key = 20240107").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend, sunday.week_of_year) == (1, "Sunday", True, 1)
    assert gold.missing_dates({"f": model["sales"]}, model["date"]).first().missing_dates == 0


def test_sales_base_drops_cancelled_and_orphans(model, rows):
    assert rows(model["base"], "invoice_item_id") == [(11,), (12,), (21,)]


def test_product_ranking_leaves_out_products_only_returned(model):
    ranking = diamond.product_ranking(model["base"], model["returned"], model["product"])
    found = {r.product_id: r for r in ranking.collect()}
    assert sorted(found) == [20, 21]
    assert found[20].returned_amount == 0 and found[20].return_rate == 0.0 and found[20].invoice_count == 2
    assert (found[20].rank_net_revenue, found[21].rank_net_revenue) == (1, 2)
    assert found[21].rank_returned_amount == 1 and found[21].return_rate == 20 / 30


def test_target_vs_actual_three_cases(model):
    table = diamond.target_vs_actual(model["base"], model["aims"], model["person"], model["region"])
    found = {(r.salesperson_key, r.target_month): r for r in table.collect()}
    assert sorted(found) == [(1, 1), (1, 2), (1, 3), (2, 3)]
    assert found[1, 1].target_attainment == 24 / 88 and found[1, 1].has_target
    assert found[1, 2].actual_net_revenue == 0 and found[1, 2].target_attainment == 0.0
    assert found[1, 3].target_value is None and found[1, 3].target_attainment is None and not found[1, 3].has_target
    assert found[2, 3].target_attainment is None and found[2, 3].has_target
    check = diamond.attainment_check(table).first()
    assert (check.rows_with_target, check.without_attainment) == (3, 1)


def test_kpis_and_their_gaps(model):
    kpis = diamond.commercial_kpis(model["base"], model["returned"], model["aims"])
    found = {r.year_month: r for r in kpis.collect()}
    assert sorted(found) == ["2024-01", "2024-03"]  # December has returns but no sales
    assert found["2024-01"].target_attainment == 24 / 88 and found["2024-03"].target_attainment is None
    assert found["2024-03"].returned_amount == d("20") and found["2024-01"].returned_amount == 0
    assert found["2024-01"].active_customers == found["2024-01"].invoice_count == 1
    growth = {r.year_month: r.net_revenue_growth for r in measures.month_over_month(kpis).collect()}
    assert growth == {"2024-01": None, "2024-03": None}


def test_reconciliation(model):
    monthly = diamond.monthly_sales(model["base"], model["region"])
    off = monthly.withColumn("net_revenue", monthly.net_revenue + 1)
    found = {r.table_name: r.ok for r in diamond.revenue_check(model["base"], {"a": monthly, "b": off}).collect()}
    assert found == {"a": True, "b": False}
    assert diamond.invoice_count_check(model["base"], monthly).first().ok
    kpis = diamond.commercial_kpis(model["base"], model["returned"], model["aims"])
    assert diamond.kpi_check(kpis, monthly).first().mismatched_months == 0
    assert diamond.kpi_check(kpis, off).first().mismatched_months == 2


def test_growth_looks_back_over_the_year_end(spark, rows):
    kpis = spark.createDataFrame(
        [("2023-01", 2023, 1, 80.0), ("2023-12", 2023, 12, 100.0), ("2024-01", 2024, 1, 120.0), ("2024-03", 2024, 3, 5.0)],
        "year_month string, year int, month int, net_revenue double",
    )
    assert rows(measures.month_over_month(kpis), "year_month", "previous_net_revenue", "net_revenue_growth") == [
        ("2023-01", None, None), ("2023-12", None, None), ("2024-01", 100.0, 0.2), ("2024-03", None, None)]
    assert rows(measures.year_over_year(kpis), "year_month", "net_revenue_growth") == [
        ("2023-01", None), ("2023-12", None), ("2024-01", 0.5), ("2024-03", None)]


def test_attainment_is_weighted(spark):
    rows = [("N", 2024, 1, 50.0, 100.0), ("N", 2024, 1, 300.0, 200.0), ("N", 2024, 2, 80.0, None)]
    df = spark.createDataFrame(rows, "region_name string, target_year int, target_month int,"
                                     " actual_net_revenue double, target_value double")
    change = {r.target_month: r for r in measures.attainment_change(df).collect()}
    assert change[1].target_attainment == 350 / 300 and change[1].attainment_change_pp is None
    assert change[2].previous_attainment == 350 / 300 and change[2].attainment_change_pp is None


def test_rank_reacts_to_the_filter_and_top_breaks_ties(spark, rows):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", 9.0), (3, "a", 7.0), (4, "a", 7.0)],
                               "k int, c string, net_revenue double")
    ranked = measures.rank_selected(df, {"c": ["a"]}, "r")
    assert rows(ranked, "k", "r") == [(1, 2), (3, 1), (4, 1)]
    assert [r.k for r in measures.top(df, "net_revenue", "k", 3).collect()] == [2, 3, 4]


def test_card_text(spark):
    df = spark.sql("SELECT * FROM VALUES (1234567.891, 0.0512D), (10.0, -0.5D), (10.0, NULL), (NULL, NULL) AS t(a, c)")
    assert [r[0] for r in df.select(kpi_card("a", "c")).collect()] == [
        "R$ 1,234,567.89  ▲ 5.1%", "R$ 10.00  ▼ -50.0%", "R$ 10.00  ▲ ", "  ▲ "]


def test_source_reports(model, rows):
    assert rows(reports.invoices_per_month(model["header"])) == [(2024, 1, 1, 0), (2024, 3, 2, 1)]
    assert rows(reports.invoices_without_items(model["header"], model["items"].filter("invoice_id <> 2"))) == [(2, "N2")]
    assert rows(reports.future_invoices(model["header"], datetime(2024, 3, 5)), "invoice_id") == [(3,)]
    assert rows(reports.returns_by_product(model["returns"], model["product"]), "product_name", "return_count") == [
        ("p21", 2), ("p22", 1)]
