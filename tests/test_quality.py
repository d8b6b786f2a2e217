from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.operators.quality import (
    REASON_TEXT,
    REASONS,
    check_foreign_key,
    check_has_related,
    check_not_future,
    check_not_null,
    check_positive,
    deduplicate_latest,
    split_valid_rejected,
)


def reasons(df, key="vessel"):
    return {r[0]: sorted(r[1]) for r in df.select(key, REASONS).collect()}


# Port calls of ships; the texts of the reasons are the library's own fixed values.
CALLS = "vessel string, berth string, tons decimal(9,1), crew int, arrival timestamp_ntz"


def calls(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], CALLS)


def test_not_null_names_every_missing_column(spark):
    df = calls(spark, ("Aurora", "N4"), ("Borealis", None), (None, None), ("Calypso", ""))
    found = reasons(check_not_null(df, ["berth", "vessel"]))
    assert found == {
        "Aurora": [],
        "Borealis": ["berth_is_null"],
        None: ["berth_is_null", "vessel_is_null"],
        "Calypso": [],  # empty is not missing
    }


@pytest.mark.parametrize(
    "allow_zero, flagged, reason",
    [(False, {"half", "nil", "tenth"}, "tons_zero_or_negative"), (True, {"half", "tenth"}, "tons_negative")],
)
def test_positive_on_decimals(spark, allow_zero, flagged, reason):
    amounts = {"half": "-0.5", "nil": "0.0", "tenth": "-0.1", "small": "0.1", "large": "88000.0", "unknown": None}
    df = calls(spark, *[(name, "S1", None if t is None else Decimal(t)) for name, t in amounts.items()])
    assert reasons(check_positive(df, "tons", allow_zero)) == {n: [reason] if n in flagged else [] for n in amounts}


def test_not_future_against_a_given_time_and_against_now(spark):
    noon = datetime(2031, 5, 17, 12)
    times = {"exact": noon, "tick": noon + timedelta(microseconds=1), "before": noon - timedelta(days=400), "open": None}
    df = calls(spark, *[(n, "E2", None, 9, t) for n, t in times.items()])
    flagged = {n for n, r in reasons(check_not_future(df, "arrival", noon)).items() if r == ["arrival_in_future"]}
    assert flagged == {"tick"}
    yesterday = datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(days=1)
    df = calls(spark, ("past", "E2", None, 9, yesterday), ("far", "E2", None, 9, yesterday + timedelta(days=3)))
    assert reasons(check_not_future(df, "arrival")) == {"past": [], "far": ["arrival_in_future"]}


@pytest.mark.parametrize(
    "known, accepted",
    [
        (["N4", "S1", "W9"], {"Aurora", "Dione", "Europa"}),
        (["S1"] * 40 + [None] * 3, {"Dione"}),
        ([], set()),
        ([None], set()),
    ],
)
def test_foreign_key(spark, known, accepted):
    df = calls(spark, ("Aurora", "N4"), ("Dione", "S1"), ("Europa", "N4"), ("Fram", None)).repartition(3)
    harbour = spark.createDataFrame([(k, 7) for k in known], "place string, depth int")
    checked = check_foreign_key(df, "berth", harbour, "place")
    assert checked.columns == [*df.columns, REASONS] and checked.count() == 4
    valid = accepted if "N4" in known else accepted & {"Dione"}
    assert reasons(checked) == {v: [] if v in valid else ["berth_not_found"] for v in ("Aurora", "Dione", "Europa", "Fram")}


@pytest.mark.parametrize("manifests", [{"Aurora": 3}, {"Aurora": 1, "Dione": 250}, {}, {"Ghost": 5}])
def test_has_related(spark, manifests):
    df = calls(spark, ("Aurora", "N4"), ("Dione", "S1"))
    lines = [(ship, n) for ship, count in manifests.items() for n in range(count)]
    cargo = spark.createDataFrame(lines, "ship string, line int")
    found = reasons(check_has_related(df, "vessel", cargo, "ship"))
    assert found == {v: [] if v in manifests else ["no_related_records_via_ship"] for v in ("Aurora", "Dione")}


def test_checks_add_up_and_a_reason_counts_once(spark):
    df = calls(spark, ("Gaia", None, Decimal("-7.5"), 0))
    checked = check_positive(check_positive(check_not_null(df, ["berth"]), "tons"), "crew")
    expected = {"Gaia": ["berth_is_null", "crew_zero_or_negative", "tons_zero_or_negative"]}
    assert reasons(checked) == expected
    assert reasons(check_not_null(check_positive(checked, "crew"), ["berth"])) == expected


def test_deduplicate_by_two_keys_with_missing_times(spark, rows):
    """The latest call per ship and berth; a call without time loses to any other."""
    day = datetime(2030, 1, 1)
    log = [
        ("Aurora", "N4", Decimal(5), 1, None),
        ("Aurora", "N4", Decimal(6), 2, day),
        ("Aurora", "N4", Decimal(7), 3, day + timedelta(hours=1)),
        ("Aurora", "S1", Decimal(8), 4, day - timedelta(days=9)),
        ("Dione", None, Decimal(9), 5, None),
        ("Dione", None, Decimal(10), 6, day),
    ]
    latest = deduplicate_latest(spark.createDataFrame(log, CALLS).repartition(4), ["vessel", "berth"], "arrival")
    assert sorted(r.crew for r in latest.collect()) == [3, 4, 6]
    assert latest.columns == [c.split()[0] for c in CALLS.split(", ")]


def test_deduplicate_ties_are_settled_by_the_columns_named(spark):
    same = datetime(2030, 2, 2)
    log = [("Helios", "W9", Decimal(t), c, same) for t, c in ((3, 40), (2, 50), (2, 30), (9, 10))]
    df = spark.createDataFrame(log, CALLS)
    for order in (df, df.orderBy("crew"), df.orderBy(F.desc("tons"))):
        kept = deduplicate_latest(order, ["vessel"], "arrival", ["tons", "crew"]).collect()
        assert [(r.tons, r.crew) for r in kept] == [(2, 30)]
    assert deduplicate_latest(df, ["vessel"], "arrival").count() == 1


def test_deduplicate_limits_each_task_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = deduplicate_latest(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") > plan.index("Final") and "Partial" in plan[plan.index("Exchange"):]


def test_split_names_all_reasons_in_one_text(spark):
    df = calls(spark, ("Io", "N4", Decimal(1), 4), ("Juno", None, Decimal(1), -4), ("Kari", "N4", None, 0))
    valid, rejected = split_valid_rejected(check_positive(check_not_null(df, ["berth", "tons"]), "crew"))
    assert [r.vessel for r in valid.collect()] == ["Io"] and valid.columns == df.columns
    assert rejected.columns == [*df.columns, REASON_TEXT]
    assert {r.vessel: r[REASON_TEXT] for r in rejected.collect()} == {
        "Juno": "berth_is_null, crew_zero_or_negative",
        "Kari": "tons_is_null, crew_zero_or_negative",
    }


def test_split_without_checks_and_of_nothing_valid(spark):
    df = calls(spark, *[(f"ship {i}", None) for i in range(7)])
    valid, rejected = split_valid_rejected(df)
    assert (valid.count(), rejected.count()) == (7, 0) and REASONS not in valid.columns
    valid, rejected = split_valid_rejected(check_not_null(df, ["berth"]))
    assert (valid.count(), {r[REASON_TEXT] for r in rejected.collect()}) == (0, {"berth_is_null"})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(-2, 2))), max_size=20))
def test_split_is_a_partition_of_the_input(spark, rows, data):
    df = spark.createDataFrame(data, "vessel string, crew int")
    valid, rejected = split_valid_rejected(check_positive(check_not_null(df, ["crew"]), "crew"))
    assert rows(valid.unionByName(rejected.drop(REASON_TEXT))) == rows(df)
