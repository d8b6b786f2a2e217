import time
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.operators.merge import duplicate_keys, last_watermark, rows_after, upsert
from tradeloom.operators.quality import deduplicate_latest
from tradeloom.plans import bronze
from tradeloom.sources import footers, jdbc
from tradeloom.sources.layers import (
    export_snapshot,
    read_layer,
    register_tables,
    require_ok,
    stored_watermark,
    table_path,
    write_table,
    write_upsert,
)
from tradeloom.sources.ledger import Batch, Ledger
from tradeloom.sources.versions import LayerVersion

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
TABLE = st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8)
MARK = datetime(2024, 1, 1, 10, 0, 5)


def frame(spark, data):
    return spark.createDataFrame(list(data.items()), "id bigint, v bigint")


@SETTINGS
@given(TABLE, TABLE)
def test_upsert_updates_inserts_and_is_idempotent(spark, rows, target, source):
    old, new = frame(spark, target), frame(spark, source)
    once = upsert(old, new, ["id"])
    expected = sorted({**target, **source}.items(), key=repr)
    assert rows(once) == expected
    assert rows(upsert(once, new, ["id"])) == expected


@SETTINGS
@given(TABLE, st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5), st.integers(0, 5)), max_size=12))
def test_upsert_of_the_latest_equals_the_latest_of_all(spark, rows, target, changes):
    old = frame(spark, target).selectExpr("id", "v", "-1L AS t")
    new = spark.createDataFrame(changes, "id bigint, v bigint, t bigint")
    merged = upsert(old, deduplicate_latest(new, ["id"], "t", ["v"]), ["id"])
    assert rows(merged) == rows(deduplicate_latest(old.unionByName(new), ["id"], "t", ["v"]))


def times(spark):
    data = [
        (1, datetime(2024, 1, 1, 10, 0, 4, 999999)),
        (2, datetime(2024, 1, 1, 10, 0, 5)),
        (3, datetime(2024, 1, 1, 10, 0, 5, 500000)),
        (4, datetime(2024, 1, 1, 10, 0, 6)),
        (5, datetime(2024, 1, 1, 10, 0, 6, 1)),
        (6, None),
    ]
    return spark.createDataFrame(data, "id int, u timestamp")


def test_rows_after_compares_whole_seconds(spark, rows):
    df = times(spark)
    assert rows(rows_after(df, "u", MARK), "id") == [(4,), (5,)]
    assert rows(rows_after(df, "u", MARK.replace(microsecond=700000)), "id") == [(4,), (5,)]
    assert rows_after(df, "u", None).count() == 6


def test_overlap_reads_the_second_of_the_mark_again(spark, rows):
    assert rows(rows_after(times(spark), "u", MARK, overlap_seconds=1), "id") == [(2,), (3,), (4,), (5,)]


def test_rows_after_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    times(spark).write.parquet(path)
    df = rows_after(spark.read.parquet(path), "u", MARK).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(u," in plan and "date_trunc" not in plan


def test_last_watermark(spark):
    assert last_watermark(times(spark), "u").first()[0] == datetime(2024, 1, 1, 10, 0, 6)
    assert last_watermark(times(spark).filter("false"), "u").first()[0] is None


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "id int, v int")
    assert rows(duplicate_keys(df, ["id"])) == [(1, 2)]


# --- storage ---


def test_paths_keep_their_scheme():
    assert table_path("s3a://bucket/lake/", "gold", "dim_date") == "s3a://bucket/lake/gold/dim_date"
    with pytest.raises(ValueError):
        table_path("x", "platinum", "t")


def test_write_upsert_rewrites_only_touched_ranges(spark, rows, tmp_path):
    root = str(tmp_path)
    path = table_path(root, "bronze", "t")
    first = spark.range(100).selectExpr("id", "'old' AS v")
    assert write_upsert(spark, first, path, "id", keys_per_range=10) == 100
    before = list((tmp_path / "bronze" / "t").rglob("*.parquet"))
    assert len(before) == 10  # one file per range of keys
    change = spark.sql("SELECT * FROM VALUES (42L, 'new'), (205L, 'add') AS t(id, v)")
    for _ in range(2):
        assert write_upsert(spark, change, path, "id", keys_per_range=10) == 2
        stored = read_layer(spark, root, "bronze", "t")
        assert stored.columns == ["id", "v"] and stored.count() == 101
        assert rows(stored.filter("v <> 'old'")) == [(205, "add"), (42, "new")]
    after = set((tmp_path / "bronze" / "t").rglob("*.parquet"))
    untouched = [p for p in before if "key_range=4" not in str(p)]
    assert len(untouched) == 9 and all(p in after for p in untouched)


def test_write_upsert_refuses_two_rows_with_one_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id bigint, v string")
    with pytest.raises(ValueError, match="share one id"):
        write_upsert(spark, df, str(tmp_path / "t"), "id")


def test_stored_watermark(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored_watermark(spark, path, "u") is None
    assert write_table(times(spark), path) == 6
    assert stored_watermark(spark, path, "u") == datetime(2024, 1, 1, 10, 0, 6)
    write_table(times(spark).filter("false"), path)
    assert stored_watermark(spark, path, "u") is None


def test_upsert_keeps_and_adds_rows_without_a_key(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = "id bigint, v string"
    stored = spark.createDataFrame([(1, "a"), (None, "old"), (2, "b")], schema)
    write_upsert(spark, stored, path, "id", keys_per_range=2)
    change = spark.createDataFrame([(2, "c"), (None, "new"), (None, "new too")], schema)
    write_upsert(spark, change, path, "id", keys_per_range=2)
    found = rows(spark.read.parquet(path), "id", "v")
    assert found == sorted([(1, "a"), (2, "c"), (None, "old"), (None, "new"), (None, "new too")], key=repr)
    write_upsert(spark, spark.createDataFrame([(9, "z")], schema), path, "id", keys_per_range=2)
    assert rows(spark.read.parquet(path), "id", "v") == sorted([*found, (9, "z")], key=repr)


def test_upsert_refuses_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    write_upsert(spark, spark.range(3).selectExpr("id", "id AS v"), path, "id")
    with pytest.raises(ValueError, match="w"):
        write_upsert(spark, spark.range(3).selectExpr("id", "id AS v", "id AS w"), path, "id")


@pytest.mark.parametrize(
    "mark, overlap, expected",
    [
        (datetime(2031, 5, 3), 0, [4, 5]),
        (datetime(2031, 5, 3, 23, 59, 59), 0, [4, 5]),
        (datetime(2031, 5, 3, 23, 59, 58), 0, [4, 5]),
        (datetime(2031, 5, 3), 1, [3, 4, 5]),
        (datetime(2031, 5, 2, 23, 59, 59), 0, [3, 4, 5]),
    ],
)
def test_rows_after_on_dates(spark, mark, overlap, expected):
    df = spark.range(1, 6).selectExpr("id", "make_date(2031, 5, int(id)) AS d")
    assert [r.id for r in rows_after(df, "d", mark, overlap).orderBy("id").collect()] == expected


def test_snapshot_is_compared(spark, tmp_path):
    df = spark.range(500).selectExpr("id AS b", "id * 2 AS a").repartition(6)
    result = export_snapshot(df, str(tmp_path / "monthly_sales"))
    assert result["ok"] and result["source_count"] == result["snapshot_count"] == 500
    assert len(list((tmp_path / "monthly_sales").glob("*.parquet"))) == 6  # as the writer's tasks leave them
    assert export_snapshot(df, str(tmp_path / "one"), files=1)["ok"] and len(list((tmp_path / "one").glob("*.parquet"))) == 1
    require_ok([result])
    with pytest.raises(RuntimeError, match="monthly_sales"):
        require_ok([{**result, "ok": False}])


def test_register_tables_for_sql(spark, tmp_path):
    root = str(tmp_path)
    write_table(spark.range(3), table_path(root, "gold", "dim_date"))
    for _ in range(2):
        assert register_tables(spark, root, "gold", ["dim_date"]) == ["gold_dim_date"]
    assert spark.sql("SELECT count(*) FROM gold_dim_date").first()[0] == 3
    spark.sql("DROP VIEW gold_dim_date")


# --- database options; no database is started ---


def test_database_options():
    base = jdbc.Database("jdbc:x", user="u", options={"encrypt": "true"})
    assert base.reader_options() == {"url": "jdbc:x", "user": "u", "encrypt": "true"}
    split = jdbc.Split("id", "0", "100", 4)
    assert split.reader_options()["numPartitions"] == "4"


def test_times_are_those_of_the_session_and_not_of_the_process(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    text = "CAST('2024-01-01 10:00:0' || id AS timestamp) AS u"
    spark.range(5).selectExpr("id", text).write.parquet(path)
    monkeypatch.setenv("TZ", "America/Sao_Paulo")
    time.tzset()
    try:
        mark = stored_watermark(spark, path, "u")
        assert mark == datetime(2024, 1, 1, 10, 0, 4)
        earlier = mark.replace(second=2)
        assert rows(rows_after(spark.read.parquet(path), "u", earlier), "id") == [(3,), (4,)]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_connections_follow_the_rows():
    assert jdbc.bounds_query("erp.T", "ID") == "SELECT MIN(ID) AS lowest, MAX(ID) AS highest, COUNT(*) AS row_count FROM erp.T"
    after = jdbc.bounds_query("erp.T", "ID", "UpdatedAt", datetime(2024, 1, 2, 3, 4, 5, 678))
    assert after.endswith(" FROM erp.T WHERE UpdatedAt >= '2024-01-02T03:04:05'")
    assert jdbc.bounds_query("erp.T", "ID", "UpdatedAt", None) == jdbc.bounds_query("erp.T", "ID")
    assert jdbc.derive_split("id", None, None, 0) is None and jdbc.derive_split("id", 5, 5, 9_000_000) is None
    assert jdbc.derive_split("id", 1, 900_000, 1_000_000) is None
    split = jdbc.derive_split("id", 1, 4_000_000, 3_500_001)
    assert split.reader_options() == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "4000001", "numPartitions": "4"}
    assert jdbc.derive_split("id", -10, 10**12, 10**10).parts == jdbc.MOST_PARTS
    assert jdbc.derive_split("id", 1, 3, 10**7).parts == 3


@pytest.mark.parametrize("mark", [None, datetime(2024, 1, 2)])
def test_an_extract_divides_tables_with_a_key(spark, monkeypatch, mark):
    asked, read = [], []
    split = jdbc.Split("ProductID", "1", "9", 2)
    monkeypatch.setattr(bronze, "find_split", lambda *a: asked.append(a[2:]) or split)
    monkeypatch.setattr(bronze, "read_incremental", lambda *a: read.append(a[2:]))
    tables = {t.source: t for t in bronze.SOURCE_TABLES}
    extract = bronze.database_extract(spark, jdbc.Database("jdbc:x"), {"erp.Customers": jdbc.Split("CustomerID", "0", "1", 7)})
    for source in ("erp.Products", "erp.Regions", "erp.Customers"):
        extract(tables[source], mark)
    assert asked == [("erp.Products", "ProductID", "UpdatedAt", mark)]
    assert [(r[0], r[3] and r[3].parts) for r in read] == [("erp.Products", 2), ("erp.Regions", None), ("erp.Customers", 7)]


def test_footers_answer_counts_and_bounds(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id, date_add(DATE '2031-01-01', cast(id % 50 AS int)) AS d, cast(id AS string) AS s, cast(id AS decimal(9, 2)) AS m FROM range(1000)").write.parquet(path)
    for column, bounds in (("id", (0, 999, 1000)), ("d", (date(2031, 1, 1), date(2031, 2, 19), 1000)), ("m", (0, 999, 1000))):
        assert footers.stored_bounds(spark, path, column) == bounds
        found = footers.bounds(footers.read_footers(spark, path), column)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert footers.has_bounds(spark.read.parquet(path), column) == ("PushedAggregation: [MIN(" in plan) == (column != "m")
    marked = last_watermark(footers.read_footers(spark, path), "d")
    assert marked.first()[0] == date(2031, 2, 19)
    counted = footers.read_footers(spark, path).agg(F.count("*"))
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as it was
    spark.range(0).selectExpr("id").write.parquet(f"{path}/none")
    assert footers.stored_bounds(spark, f"{path}/none", "id") == (None, None, 0)
    version = LayerVersion(str(tmp_path), "gold")
    spark.range(7).write.parquet(version.path("t7"))
    assert footers.stored_counts(spark, version, ["t7"]) == {"t7": 7}


class Died(Exception):
    """Stands for a lost driver."""


def test_a_batch_that_died_after_the_upsert_is_repeated_unchanged(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path), next(t for t in bronze.SOURCE_TABLES if t.source == "erp.Products")
    source = {1: "2031-01-01 00:00:01", 2: "2031-01-01 00:00:05.5"}
    marks = []

    def extract(_, mark):
        marks.append(mark)
        rows = [(k, "n", "c", t) for k, t in source.items()]
        df = spark.createDataFrame(rows, "ProductID int, ProductName string, CategoryName string, t string")
        return rows_after(df.select("ProductID", "ProductName", "CategoryName", F.to_timestamp("t").alias("UpdatedAt")), "UpdatedAt", mark)

    def ingest(batch):
        return bronze.ingest_table(spark, table, extract, root, batch, "erp")

    ledger = Ledger(spark, root, table.bronze)
    assert ingest("b1") == 2 and ledger.last() == Batch("b1", "incremental", 2, datetime(2031, 1, 1, 0, 0, 5))
    source[2], source[3] = "2031-01-01 00:00:07", "2031-01-01 00:00:09"

    def dies(*_):
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "add", dies)
        with pytest.raises(Died):
            ingest("b/2")
    stored = read_layer(spark, root, "bronze", table.bronze)
    assert stored.count() == 3 and ledger.last().batch_id == "b1"  # the upsert had happened
    assert ingest("b/2") == 2 and marks[-1] == marks[-2] == datetime(2031, 1, 1, 0, 0, 5)
    after = ledger.last()
    assert after == Batch("b/2", "incremental", 2, datetime(2031, 1, 1, 0, 0, 9)) and ledger.find("b/2") == after
    assert read_layer(spark, root, "bronze", table.bronze).count() == 3
    # a finished batch is recognised and asks the source nothing; one without rows keeps the mark
    assert ingest("b/2") == 2 and len(marks) == 3
    assert ingest("b3") == 0 and ledger.last() == Batch("b3", "incremental", 0, datetime(2031, 1, 1, 0, 0, 9))
    full = next(t for t in bronze.SOURCE_TABLES if t.source == "erp.Regions")

    def regions(n):
        return spark.range(n).selectExpr("id AS RegionID", "'r' AS RegionName")

    assert bronze.ingest_table(spark, full, lambda *_: regions(4), root, "b1", "erp") == 4
    assert bronze.ingest_table(spark, full, lambda *_: regions(9), root, "b1", "erp") == 4
    assert read_layer(spark, root, "bronze", full.bronze).count() == 4
