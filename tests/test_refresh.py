"""All layers end to end on the given tables, stored and refreshed twice."""

import pytest
from pyspark.sql import functions as F
from workload.registry import Model
from workload.tables import AS_OF

from tradeloom.operators.checks import fingerprint
from tradeloom.plans import refresh
from tradeloom.plans.bronze import SOURCE_TABLES, WATERMARK, ingest_all, ingest_table
from tradeloom.operators.merge import rows_after
from tradeloom.operators.quality import deduplicate_latest
from tradeloom.operators.schema import drop_control_columns
from tradeloom.sources import layers
from tradeloom.sources.layers import read_layer
from tradeloom.sources.versions import PUBLISHED, VERSIONS, current_version, file_names, layer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    model = Model(spark, SF)

    def extract(table, mark):
        """The source has one current row per key."""
        rows = drop_control_columns(model.bronze[table.bronze])
        if not table.key:
            return rows
        others = [c for c in rows.columns if c not in (table.key, WATERMARK)]
        return rows_after(deduplicate_latest(rows, [table.key], WATERMARK, others), WATERMARK, mark)

    first = ingest_all(spark, extract, root, "b1", "erp")
    second = ingest_all(spark, extract, root, "b2", "erp")
    silver = refresh.refresh_silver(spark, root, AS_OF)
    gold = refresh.refresh_gold(spark, root)
    return {"root": root, "first": first, "second": second, "silver": silver, "gold": gold}


def prints(spark, root, layer):
    return {t: fingerprint(read_layer(spark, root, layer, t)).first() for t in refresh.LAYER_TABLES[layer]}


def test_a_second_ingest_finds_nothing_new(spark, lake):
    for table in SOURCE_TABLES:
        assert lake["first"][table.bronze] > 0
        assert lake["second"][table.bronze] == (0 if table.key else lake["first"][table.bronze])
        stored = read_layer(spark, lake["root"], "bronze", table.bronze)
        assert stored.count() == lake["first"][table.bronze]
        assert {r[0] for r in stored.select("batch_id").distinct().collect()} == {"b1" if table.key else "b2"}


def test_every_bronze_key_is_valid_or_rejected(spark, lake):
    for table, counts in lake["silver"].items():
        assert counts["valid"] > 0
        assert read_layer(spark, lake["root"], "silver", table).count() == counts["valid"]
        quarantine = read_layer(spark, lake["root"], "silver", f"{table}_quarantine")
        assert quarantine.count() == counts["rejected"]
        assert quarantine.columns[-1] == "rejection_reason" and "batch_id" not in quarantine.columns


def test_orphans_are_items_of_missing_invoices(spark, lake):
    report = {r.table_name: r for r in refresh.orphan_report(spark, lake["root"]).collect()}
    sales = read_layer(spark, lake["root"], "gold", "fact_sales")
    assert report["fact_sales"].known_orphans == sales.filter("invoice_status IS NULL").count() > 0


def test_refresh_is_idempotent_and_reconciles(spark, lake):
    refresh.refresh_diamond(spark, lake["root"])
    before = {layer: prints(spark, lake["root"], layer) for layer in ("silver", "gold", "diamond")}
    refresh.refresh_silver(spark, lake["root"], AS_OF)
    assert refresh.refresh_gold(spark, lake["root"]) == lake["gold"]
    refresh.refresh_diamond(spark, lake["root"])
    assert before == {layer: prints(spark, lake["root"], layer) for layer in ("silver", "gold", "diamond")}


def test_snapshots_and_catalog(spark, lake, tmp_path):
    refresh.refresh_diamond(spark, lake["root"])
    results = refresh.export_diamond(spark, lake["root"], str(tmp_path))
    assert [r["table"] for r in results] == refresh.DIAMOND_TABLES and all(r["ok"] for r in results)
    names = refresh.register_all(spark, lake["root"])
    assert len(names) == 33 == len(set(names)) == sum(map(len, refresh.LAYER_TABLES.values()))
    for layer, tables in refresh.LAYER_TABLES.items():
        for table in tables:
            entry, stored = spark.table(f"{layer}_{table}"), read_layer(spark, lake["root"], layer, table)
            assert entry.columns == stored.columns and "key_range" not in entry.columns
            assert entry.count() == stored.count() > 0
    assert refresh.register_all(spark, lake["root"]) == names
    for name in names:
        spark.sql(f"DROP VIEW {name}")


def test_executive_tables_are_read_in_order(spark, lake):
    refresh.refresh_diamond(spark, lake["root"])
    for table, order in refresh.diamond.READ_ORDER.items():
        read = [tuple(r[c] for c in order) for r in refresh.read_executive(spark, lake["root"], table).collect()]
        assert read == sorted(read, key=lambda r: tuple((v is not None, v) for v in r)) and len(read) > 1


def test_a_failing_check_leaves_the_old_layer(spark, lake, monkeypatch):
    refresh.refresh_diamond(spark, lake["root"])
    before = prints(spark, lake["root"], "diamond")
    wrong = refresh.diamond.monthly_sales
    monkeypatch.setattr(refresh.diamond, "monthly_sales", lambda *a: wrong(*a).withColumn("net_revenue", F.lit(0).cast("decimal(38,6)")))
    with pytest.raises(refresh.CheckFailed, match="net revenue"):
        refresh.refresh_diamond(spark, lake["root"])
    assert prints(spark, lake["root"], "diamond") == before


def test_a_lost_row_fails_the_refresh_of_gold(spark, lake, monkeypatch):
    before = current_version(spark, lake["root"], "gold")
    whole = refresh.gold.dim_region
    monkeypatch.setattr(refresh.gold, "dim_region", lambda *a: whole(*a).limit(1))
    with pytest.raises(refresh.CheckFailed, match="row counts.*dim_region"):
        refresh.refresh_gold(spark, lake["root"])
    assert current_version(spark, lake["root"], "gold") == before


class Stopped(Exception):
    """Stands for a lost driver."""


def names(spark, root, layer):
    folder = layer_path(root, layer)
    return file_names(spark, f"{folder}/{VERSIONS}"), file_names(spark, f"{folder}/{PUBLISHED}")


@pytest.mark.parametrize("layer, table", [("gold", "fact_returns"), ("diamond", "target_vs_actual")])
def test_a_refresh_that_stops_between_two_tables_changes_nothing(spark, lake, monkeypatch, layer, table):
    run = {"gold": refresh.refresh_gold, "diamond": refresh.refresh_diamond}[layer]
    run(spark, lake["root"])
    before, version = prints(spark, lake["root"], layer), current_version(spark, lake["root"], layer)
    write = refresh.write_observed

    def stops(df, path, totals=None):
        if path.endswith(f"/{table}"):
            raise Stopped
        return write(df.limit(1), path, totals)  # what is written before is not what readers had

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "write_observed", stops)
        with pytest.raises(Stopped):
            run(spark, lake["root"])
    assert prints(spark, lake["root"], layer) == before
    assert current_version(spark, lake["root"], layer) == version
    left = [v for v in names(spark, lake["root"], layer)[0] if v > version.name]
    assert left
    run(spark, lake["root"])
    assert not set(left) & set(names(spark, lake["root"], layer)[0]) and prints(spark, lake["root"], layer) == before


def test_a_refresh_that_stops_at_its_last_step_is_one_version(spark, lake, monkeypatch):
    refresh.refresh_diamond(spark, lake["root"])
    before = current_version(spark, lake["root"], "diamond")

    def stops(*_):
        raise Stopped

    for step, moved in (("publish_version", False), ("drop_old_versions", True)):
        with monkeypatch.context() as patch:
            patch.setattr(refresh, step, stops)
            with pytest.raises(Stopped):
                refresh.refresh_diamond(spark, lake["root"])
        assert (current_version(spark, lake["root"], "diamond") != before) == moved
        assert all(prints(spark, lake["root"], "diamond").values())


def test_a_reader_keeps_its_version_for_one_refresh(spark, lake):
    refresh.refresh_diamond(spark, lake["root"])
    reader = current_version(spark, lake["root"], "diamond")
    rows = reader.read(spark, "monthly_sales")
    refresh.refresh_diamond(spark, lake["root"])
    newer = current_version(spark, lake["root"], "diamond")
    assert newer.name > reader.name and rows.count() == newer.read(spark, "monthly_sales").count()
    refresh.refresh_diamond(spark, lake["root"])
    versions, marks = names(spark, lake["root"], "diamond")
    assert len(versions) == len(marks) == 2 and reader.name not in versions and versions == marks


def test_catalog_entries_follow_the_newest_version(spark, lake):
    refresh.refresh_diamond(spark, lake["root"])
    refresh.register_tables(spark, lake["root"], "diamond", ["commercial_kpis"])
    count = spark.table("diamond_commercial_kpis").count()
    for _ in range(3):
        refresh.refresh_diamond(spark, lake["root"])
    assert spark.table("diamond_commercial_kpis").count() == count > 0
    assert not spark.catalog.tableExists("diamond_monthly_sales")
    spark.sql("DROP VIEW diamond_commercial_kpis")


def test_totals_taken_while_writing(spark, lake, monkeypatch):
    refresh.refresh_gold(spark, lake["root"])
    source = current_version(spark, lake["root"], "gold")
    facts = source.read(spark, "fact_sales")
    total = refresh.diamond.sales_base(facts).agg(F.sum("net_revenue")).first()[0]
    assert refresh._issued_revenue(spark, source, None) == total > 0
    assert source.totals(spark)["fact_sales"]["rows"] == facts.count()
    monkeypatch.setattr(type(source), "totals", lambda *_: {})
    assert refresh._issued_revenue(spark, source, facts) == total
    assert refresh._issued_revenue(spark, source, facts.filter("false")) == 0


def test_an_export_with_one_altered_value_fails(spark, lake, tmp_path, monkeypatch):
    refresh.refresh_diamond(spark, lake["root"])
    write = layers.write_observed

    def alters(df, path, totals=None, files=None):
        """The rows that arrive differ in one value from those that were counted."""
        seen = write(df, path, totals, files)
        changed = spark.read.parquet(path).withColumn("net_revenue", F.when(F.col("rank_net_revenue") == 1, 0).otherwise(F.col("net_revenue")))
        kept = changed.collect()
        spark.createDataFrame(kept, spark.read.parquet(path).schema).write.mode("overwrite").parquet(path)
        return seen

    table = read_layer(spark, lake["root"], "diamond", "product_ranking")
    good = layers.export_snapshot(table, str(tmp_path / "good"), files=1)
    assert good["ok"] and good["content_matches"]
    monkeypatch.setattr(layers, "write_observed", alters)
    bad = layers.export_snapshot(table, str(tmp_path / "bad"))
    assert bad["source_count"] == bad["snapshot_count"] and bad["columns_match"] and not bad["content_matches"]
    with pytest.raises(RuntimeError, match="bad"):
        layers.require_ok([good, bad])


def test_misread_texts_are_repaired_on_the_way_in(spark, tmp_path):
    source = spark.sql("SELECT 1 AS ProductID, 'MÃ³vel' AS ProductName, 'SÃ£o' AS CategoryName, TIMESTAMP '2031-05-17 12:00:00' AS UpdatedAt")
    table = next(t for t in SOURCE_TABLES if t.source == "erp.Products")
    assert ingest_table(spark, table, lambda t, mark: source, str(tmp_path), "b", "erp") == 1
    stored = read_layer(spark, str(tmp_path), "bronze", table.bronze).first()
    assert (stored.ProductName, stored.CategoryName, stored.UpdatedAt) == ("Móvel", "São", source.first().UpdatedAt)


def test_a_check_that_fails_stops_the_refresh(spark, lake):
    with pytest.raises(refresh.CheckFailed, match="row counts"):
        refresh._require("row counts", spark.range(1).withColumn("ok", F.lit(False)))
