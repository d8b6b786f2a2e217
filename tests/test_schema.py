import re
from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tradeloom.functions.text import misread_as_cp1252, repair_encoding
from tradeloom.plans.bronze import repair_source
from tradeloom.operators.schema import (
    CONTROL_COLUMNS,
    add_control_columns,
    cast_columns,
    drop_control_columns,
    fill_nulls,
    new_batch_id,
    repair_text_columns,
    snake_case,
    standardize_columns,
)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("BerthNumber", "berth_number"),
        ("GPSFix", "gps_fix"),
        ("VesselIMO", "vessel_imo"),
        ("already_flat", "already_flat"),
        ("RadarXYPlot", "radar_xy_plot"),
        ("Draught3", "draught3"),
        ("Deck4Load", "deck4_load"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


@given(st.text(alphabet="aBcDE1_", min_size=1, max_size=10))
def test_snake_case_is_stable_and_only_adds_underscores(name):
    once = snake_case(name)
    assert snake_case(once) == once
    assert once.replace("_", "") == name.replace("_", "").lower()


def test_standardize_keeps_rows(spark, rows):
    log = [("Aurora", 11.5, None), ("Borealis", None, True), ("Aurora", 11.5, None)]
    df = spark.createDataFrame(log, "VesselName string, MaxDraught double, inPort boolean")
    assert standardize_columns(df).columns == ["vessel_name", "max_draught", "in_port"]
    assert rows(standardize_columns(df)) == rows(df)


def test_standardize_refuses_colliding_names(spark):
    with pytest.raises(ValueError, match="collide"):
        standardize_columns(spark.range(1).selectExpr("id AS PilotID", "id AS pilot_id"))


def test_control_columns_are_added_and_dropped(spark):
    df = spark.createDataFrame([("Aurora", 3)], "vessel string, calls int")
    noon = datetime(2031, 5, 17, 12)
    stamped = add_control_columns(df, "harbour", "harbour.calls", "night-7", "incremental", noon)
    assert stamped.columns == ["vessel", "calls", *CONTROL_COLUMNS]
    assert tuple(stamped.first()) == ("Aurora", 3, noon, "harbour", "harbour.calls", "night-7", "incremental")
    some = stamped.drop("load_type", "source_table")
    assert all(drop_control_columns(d).columns == df.columns for d in (stamped, some, df))


def test_batch_id_format():
    assert re.fullmatch(r"20240102030405-[0-9a-f]{8}", new_batch_id(datetime(2024, 1, 2, 3, 4, 5)))


def test_cast_ignores_unknown_columns_and_bad_text(spark, rows):
    log = [("7", "2031-05-17", "88.25"), ("seven", "17 May", "1e3"), (None, "", "-0")]
    df = spark.createDataFrame(log, "crew string, arrival string, tons string")
    result = cast_columns(df, {"tons": "decimal(8,2)", "crew": "smallint", "arrival": "date", "keel": "date"})
    assert result.dtypes == [("crew", "smallint"), ("arrival", "date"), ("tons", "decimal(8,2)")]
    assert rows(result) == rows(spark.sql("""SELECT * FROM VALUES (7S, DATE '2031-05-17', 88.25BD), (NULL, NULL, 1000.00BD),
        (NULL, NULL, 0.00BD)"""))


def test_fill_nulls_keeps_the_type(spark):
    df = spark.sql("SELECT cast(NULL AS decimal(12,2)) AS v, 'a' AS w")
    filled = fill_nulls(df, {"v": 0.0})
    assert filled.dtypes == df.dtypes and filled.first().v == 0


REPAIRS = [
    ("SÃ£o Paulo", "São Paulo"),
    ("DivergÃªncia", "Divergência"),
    ("â‚¬5", "€5"),
    ("São Paulo", "São Paulo"),
    ("abc", "abc"),
    ("", ""),
    (None, None),
    ("漢字", "漢字"),
    ("x\u0081y", "x\u0081y"),
    ("Ã\u009d", "Ã\u009d"),
    ("Ã", "Ã"),
]


def by_rule(text):
    """What the bytes say: Windows-1252 bytes that are valid UTF-8 are read as such."""
    try:
        return None if text is None else text.encode("cp1252").decode("utf-8")
    except UnicodeError:
        return text


def test_repair_encoding(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(REPAIRS)], "i int, v string")
    fixed = {r.i: r.f for r in df.select("i", repair_encoding("v").alias("f")).collect()}
    assert [fixed[i] for i in range(len(REPAIRS))] == [b for _, b in REPAIRS] == [by_rule(a) for a, _ in REPAIRS]


def test_repair_follows_the_rule_on_every_two_byte_text(spark):
    texts = [bytes([a, b]).decode("latin-1") for a in range(0x7E, 0x100, 3) for b in range(0x7E, 0x100)]
    texts += [t.encode().decode("cp1252", "ignore") for t in "ãêç€—“”漢é" for _ in (0,)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for row in df.select("v", repair_encoding("v").alias("f")).collect():
        assert row.f == by_rule(row.v)


def test_damage_and_repair_cancel_out(spark):
    texts = ["São Paulo", "naïve — “quote” €", "plain", "漢字 é"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").withColumn("d", misread_as_cp1252("v"))
    for row in df.select("v", "d", repair_encoding("d").alias("f")).collect():
        assert row.d is None or row.f == row.v


def test_repaired_rows_get_a_new_time(spark, rows):
    old, now = datetime(2020, 1, 1), datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "SÃ£o", old), (2, "ok", old), (3, None, old)], "id int, n string, u timestamp")
    result = repair_text_columns(df, ["n"], "u", now)
    assert rows(result) == [(1, "São", now), (2, "ok", old), (3, None, old)]


def test_repair_knows_each_tables_texts(spark):
    old = datetime(2020, 1, 1)
    df = spark.createDataFrame([("MÃ³vel", "SÃ£o", old)], "ProductName string, Other string, UpdatedAt timestamp")
    df = df.withColumn("CategoryName", df.ProductName)
    row = repair_source(df, "erp.Products").first()
    assert (row.ProductName, row.CategoryName, row.Other) == ("Móvel", "Móvel", "SÃ£o") and row.UpdatedAt > old
    assert repair_source(df, "erp.SalesTargets") is df
