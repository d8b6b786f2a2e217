"""Distinct counts by words of bits, and earlier months by window frames."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from workload.registry import QUERIES, Model

from tradeloom.operators.distinct import with_distinct_counts
from tradeloom.plans import diamond, measures

SF = "/root/testdata/sf0.001"
FIXTURE = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
IDS = st.one_of(st.none(), st.integers(-70, 70), st.sampled_from([2**63 - 1, -(2**63), 2**40, 63, 64]))
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), IDS, IDS, st.integers(-5, 5)), max_size=30)


@FIXTURE
@given(ROWS)
def test_counts_and_sums_equal_those_of_a_plain_group_by(spark, rows, data):
    df = spark.createDataFrame(data, "g int, a bigint, b bigint, v int").withColumn("w", F.col("v").cast("decimal(12,2)"))
    ours = with_distinct_counts(df, ["g"], {"na": "a", "nb": "b"}, {"sv": "v", "sw": "w"})
    plain = df.groupBy("g").agg(
        F.count_distinct("a").alias("na"), F.count_distinct("b").alias("nb"), F.sum("v").alias("sv"), F.sum("w").alias("sw")
    )
    assert rows(ours) == rows(plain)
    assert [f.dataType for f in ours.schema] == [f.dataType for f in plain.schema]


def test_distinct_counts_of_hot_dense_ids(spark):
    """Two thirds of the rows have one id; the others are neighbours and share words."""
    df = spark.range(90_000).selectExpr("1 AS g", "CASE WHEN id % 3 > 0 THEN 5 ELSE id END AS a")
    assert with_distinct_counts(df, ["g"], {"n": "a"}).first().n == 30_001
    with pytest.raises(TypeError, match="a is no integer"):
        with_distinct_counts(df.selectExpr("g", "cast(a AS string) AS a"), ["g"], {"n": "a"})


def test_invoices_are_counted_over_all_months(spark):
    base = spark.createDataFrame([(1,), (1,), (2,), (200,), (None,)], "invoice_id bigint")
    monthly = spark.createDataFrame([(2,), (1,)], "invoice_count bigint")
    assert tuple(diamond.invoice_count_check(base, monthly).first()) == (3, 3, True)
    assert tuple(diamond.invoice_count_check(base.filter("false"), monthly.filter("false")).first()) == (0, 0, True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_expand_no_rows(spark):
    model = Model(spark, SF).staged("items", "header", "returns")
    for df in (QUERIES["distinct_activity"](spark, SF), model.commercial_kpis):
        assert "Expand" not in plan(df) and "bit_or" in plan(df)


def months(spark, *rows):
    return spark.createDataFrame(rows, "g string, year int, month int, v int")


def test_earlier_months(spark, rows):
    df = months(spark, ("a", 2030, 11, 1), ("a", 2030, 12, 2), ("a", 2031, 1, None), ("a", 2031, 3, 4), ("a", 2031, 12, 5),
                (None, 2031, 1, 6), (None, 2031, 2, 7), ("b", None, None, 8), ("b", None, None, 9), ("b", 2031, 1, 10))
    back = measures.with_earlier_month(df, {"p": "v"}, 1, within=["g"])
    assert {(r.g, r.year, r.month, r.p) for r in back.collect() if r.p is not None} == {
        ("a", 2030, 12, 1), ("a", 2031, 1, 2), (None, 2031, 2, 6)}
    assert back.columns == [*df.columns, "p"] and back.count() == 10
    year = measures.with_earlier_month(df, {"p": "v"}, 12, within=["g"])
    assert {(r.g, r.year, r.month, r.p) for r in year.collect() if r.p is not None} == {("a", 2031, 12, 2)}
    assert measures.with_earlier_month(df.filter("false"), {"p": "v"}, 1).count() == 0


def test_earlier_months_need_no_join(spark):
    kpis = months(spark, ("a", 2030, 11, 1)).selectExpr("'2030-11' AS year_month", "year", "month", "cast(v AS decimal(12,2)) AS net_revenue", "1 AS region_key", "'r' AS region_name")
    for compared in (measures.month_over_month(kpis), measures.year_over_year(kpis), measures.region_month_over_month(kpis)):
        assert "Join" not in plan(compared) and "specifiedwindowframe(RangeFrame" in plan(compared)


def test_sums_travel_apart_from_the_ids(spark):
    """One row per group and task holds the sums; the rows of the words have none."""
    df = spark.createDataFrame([("a", 1, 2), ("a", 700, 3), ("a", None, 4), ("b", None, None)], "g string, i long, v int")
    counted = with_distinct_counts(df, ["g"], {"ids": "i"}, {"total": "v"})
    assert sorted(tuple(r) for r in counted.collect()) == [("a", 2, 9), ("b", 0, None)]
    assert "_id, -1, " in counted._jdf.queryExecution().analyzed().toString()
