import datetime
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeloom.operators.checks import fingerprint
from tradeloom.operators.joins import existence_flag, lookup_join
from tradeloom.operators.ranking import dense_ranks, number_sorted, surrogate_key, value_range

FIXTURE = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def hot_facts(spark):
    """A third of the rows on one key, a third exact copies of one row, NULL and unknown keys."""
    return (
        spark.range(300)
        .selectExpr("CASE WHEN id < 100 THEN 1 WHEN id < 200 THEN 2 WHEN id < 230 THEN NULL ELSE id END AS k",
                    "CASE WHEN id BETWEEN 100 AND 199 THEN 0 ELSE id END AS v")
    )


def test_join_keeps_all_rows(spark, rows):
    facts = hot_facts(spark)
    lookup = spark.range(0, 280, 2).selectExpr("id + 1 AS k", "concat('n', id) AS name").unionByName(
        spark.sql("SELECT 2L AS k, 'two' AS name"))
    joined = lookup_join(facts, lookup, "k")
    assert rows(joined) == rows(facts.join(lookup, "k", "left")) and joined.count() == 300
    assert joined.columns == ["k", "v", "name"]


def test_spark_splits_hot_keys_of_a_join_to_a_grouped_side(spark, tmp_path):
    """Without the rebalancing the grouped side would keep a hot key in one task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(400_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "uuid() AS v").repartition(12)
        known = spark.range(300_000).selectExpr("id % 150000 AS code")
        flagged = existence_flag(facts, "k", known, "code", "found").withColumn("task", F.spark_partition_id())
        flagged.write.parquet(str(tmp_path / "t"))
        stored = spark.read.parquet(str(tmp_path / "t"))
        tasks = stored.filter("k = 7").agg(F.count_distinct("task")).first()[0]
        assert tasks > 3
        assert stored.filter("found").count() == stored.filter("k < 150000").count() and stored.count() == 400_000
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_join_on_several_keys(spark, rows):
    facts = spark.range(60).selectExpr("id % 3 AS a", "id % 2 AS b", "id AS v")
    lookup = spark.sql("SELECT * FROM VALUES (0L, 0L, 'x'), (1L, 1L, 'y') AS t(a, b, w)")
    assert rows(lookup_join(facts, lookup, ["a", "b"])) == rows(facts.join(lookup, ["a", "b"], "left"))


@FIXTURE
@given(st.sets(st.one_of(st.integers(-99, 99), st.integers(-(2**62), 2**62)), max_size=30), st.integers(2, 20))
def test_two_step_key_equals_row_number(spark, rows, ids, id_bits):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    keyed = surrogate_key(df, "k", "id", id_bits=id_bits)
    assert rows(keyed, "id", "k") == sorted(((v, n + 1) for n, v in enumerate(sorted(ids))), key=repr)


def test_a_missing_id_comes_first(spark, rows):
    for values, kind in (((5, None, -7), "bigint"), (("b", None, "a"), "string")):
        df = spark.createDataFrame([(v,) for v in values], f"id {kind}")
        keyed = {r.id: r.k for r in surrogate_key(df, "k", "id").collect()}
        assert keyed == {None: 1, values[2]: 2, values[0]: 3}


def test_key_does_not_depend_on_layout_or_ranges(spark, rows):
    df = spark.range(0, 50_000, 7)
    keyed = surrogate_key(df.repartition(5), "k", "id", id_bits=10)
    assert rows(keyed, "id", "k") == [(i, n) for n, i in enumerate(range(0, 50_000, 7), 1)] or rows(keyed, "id", "k") == sorted(
        [(i, n) for n, i in enumerate(range(0, 50_000, 7), 1)], key=repr)
    assert fingerprint(keyed).collect() == fingerprint(surrogate_key(df.repartition(3), "k", "id")).collect()


@pytest.mark.parametrize("values", [["b1", "a2", "c3"], ["10", "9", "100"], [datetime.date(2031, 1, d) for d in (3, 1, 2)]])
def test_ids_of_other_types_are_numbered_in_their_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], ["id"])
    assert {r.id: r.k for r in surrogate_key(df, "k", "id").collect()} == {v: n for n, v in enumerate(sorted(values), 1)}


def test_key_has_no_window_over_everything(spark):
    plan = surrogate_key(spark.range(100), "k", "id")._jdf.queryExecution().executedPlan().toString()
    # the one single-task window works on the groups of ranges, after two aggregations
    single = [part for part in plan.split("\n") if "SinglePartition" in part]
    assert len(single) <= 1


@pytest.mark.parametrize("limit", ["0", "7"])
def test_numbers_and_ranks_do_not_depend_on_the_writers_files(spark, rows, limit):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", limit)
    try:
        df = spark.range(1000).selectExpr("id", "cast(id * 7919 % 1000 AS string) AS t").repartition(4)
        numbered = {r.t: r.n for r in number_sorted(df, [F.asc("t")], "n").collect()}
        assert numbered == {t: n for n, t in enumerate(sorted(str(i) for i in range(1000)), 1)}
        ranked = {r.id: r.r for r in dense_ranks(spark.range(500), {"r": "id"}).collect()}
        assert ranked == {i: 500 - i for i in range(500)}
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


VALUES = st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=25)


@FIXTURE
@given(VALUES)
def test_two_step_ranks_equal_dense_rank(spark, rows, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "i int, g int, v int")
    df = df.withColumn("w", F.col("v").cast("decimal(12,2)"))
    ranked = dense_ranks(df, {"rv": "v", "rw": "w"})
    everything = Window.orderBy(F.col("v").desc_nulls_last())
    expected = df.withColumns({"rv": F.dense_rank().over(everything), "rw": F.dense_rank().over(everything)})
    assert rows(ranked) == rows(expected)


NUMBERS = st.one_of(
    st.none(),
    st.sampled_from([0, 1, -1, 2**40, 2**40 + 1, 2**53, 2**53 + 1, -(2**53), -(2**53) - 1, 10**17, 10**17 - 1]),
    st.integers(-(10**17), 10**17),
)


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
@FIXTURE
@given(st.lists(NUMBERS, min_size=1, max_size=40))
def test_ranks_of_numbers_near_and_far(spark, rows, broadcast, data):
    """Values of all sizes, among them some that a double does not tell apart."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = spark.createDataFrame([(n, v) for n, v in enumerate(data)], "i int, v bigint")
        df = df.withColumn("w", (F.col("v") / F.lit(10**6).cast("decimal(7,0)")).cast("decimal(38,6)"))
        df = df.withColumn("x", F.col("v").cast("double"))
        ranks = {"rv": "v", "rw": "w", "rx": "x"}
        down = {n: F.dense_rank().over(Window.orderBy(F.col(c).desc_nulls_last())) for n, c in ranks.items()}
        assert rows(dense_ranks(df, ranks)) == rows(df.withColumns(down))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_of_special_floats_dates_and_text(spark, rows):
    values = [float("nan"), float("inf"), float("-inf"), 5e-324, -5e-324, 0.0, -0.0, 1e308, 1.0, 1.0000000000000002, None]
    df = spark.createDataFrame([(v, None if v is None else str(v)) for v in values], "v double, t string")
    df = df.withColumn("d", F.when(F.col("v") == 1.0, F.lit(datetime.date(2031, 5, 1))).when(F.col("v") > 1, F.lit(datetime.date(1969, 1, 1))))
    ranks = {"rv": "v", "rt": "t", "rd": "d"}
    down = {n: F.dense_rank().over(Window.orderBy(F.col(c).desc_nulls_last())) for n, c in ranks.items()}
    assert repr(rows(dense_ranks(df, ranks))) == repr(rows(df.withColumns(down)))  # NaN equals nothing in Python
    empty = dense_ranks(df.filter("false"), ranks)
    assert empty.columns == ["v", "t", "d", "rv", "rt", "rd"] and empty.count() == 0


def test_ranges_rise_with_their_values(spark):
    steps = spark.range(-2000, 2000).selectExpr("id", "CASE WHEN id < 0 THEN -1D ELSE 1D END * pow(1.37D, abs(id) - 1000D) AS v")
    ordered = [r.at for r in steps.withColumn("at", value_range("v")).orderBy("v").select("at").collect()]
    assert ordered == sorted(ordered) and len(set(ordered)) > 3000


def test_only_counts_meet_by_metric_and_group(spark):
    """No job runs before the ranks are read, and no shuffle of values goes by metric and group alone."""
    df = spark.range(1000).selectExpr("id", "cast(id % 50 AS decimal(12,2)) AS v", "id % 3 AS g", "-id AS w")
    spark.sparkContext.setJobGroup("ranks", "ranks")
    try:
        ranked = dense_ranks(df, {"rv": "v", "rw": "w"}, within=["g"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ranks")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    lines = ranked._jdf.queryExecution().executedPlan().toString().split("\n")
    met = [n for n, line in enumerate(lines) if re.search(r"hashpartitioning\(_rank#\d+, _group#\d+, \d+\)", line)]
    assert met
    for n in met:
        below = next(line for line in lines[n + 1 :] if "Aggregate" in line or "Window" in line)
        assert "max(_nth" in below
    assert "SinglePartition" not in "".join(lines)


def test_ranks_within_groups(spark, rows):
    data = [(1, "a", 5), (2, "a", 5), (3, "a", 1), (4, "b", None), (5, "b", 2), (6, None, 9), (7, None, 7)]
    df = spark.createDataFrame(data, "i int, g string, v int")
    expected = df.withColumn("r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    assert rows(dense_ranks(df, {"r": "v"}, within=["g"])) == rows(expected)


def test_number_sorted_across_many_files(spark, rows):
    df = spark.range(5000).selectExpr("cast(id * 7919 % 5000 AS string) AS t").repartition(8)
    numbered = number_sorted(df, [F.asc("t")], "n")
    ordered = sorted(str(i) for i in range(5000))
    assert rows(numbered, "t", "n") == sorted(((t, i + 1) for i, t in enumerate(ordered)), key=repr)


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS t")
    same = fingerprint(df.orderBy(F.desc("id")).select("t", "id").repartition(7)).first()
    assert fingerprint(df).first() == same
    changed = df.withColumn("t", F.when(F.col("id") == 500, F.lit("y")).otherwise(F.col("t")))
    assert fingerprint(changed).first() != same
    assert fingerprint(df.filter("false")).first().row_count == 0
