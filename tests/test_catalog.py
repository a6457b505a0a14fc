"""Names, versions, new ids, currency, collections and settings."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from halyard.config import read_config, redacted
from halyard.functions import names
from halyard.operators import catalog, collection, incremental, metrics
from halyard.sources import sheets, store


def test_rates(spark):
    rows = spark.createDataFrame([(c, 1000.0, 1000.0, 1000.0) for c in ("kenya", "zanzibar", "other", "Kenya", None)], "country string, mean_rpue double, mean_rpua double, mean_price_kg double")
    got = {r.country: r.mean_rpue for r in metrics.in_usd(rows).collect()}
    assert got == {"kenya": pytest.approx(7.7), "zanzibar": pytest.approx(0.37), "other": None, "Kenya": None, None: None}


def test_uniting_fills_and_refuses_other_types(spark):
    a, b = spark.createDataFrame([(1, "x")], "id long, p string"), spark.createDataFrame([(2, 1.0)], "id long, q double")
    assert [tuple(r) for r in metrics.unite(a, b).orderBy("id").collect()] == [(1, "x", None), (2, None, 1.0)]
    with pytest.raises(TypeError, match="id"):
        metrics.unite(a, b.withColumn("id", F.lit("2")))


def test_trip_id_of_a_name(spark):
    rows = spark.createDataFrame([("pre-tracks_123.parquet",), ("tracks_1e+05.parquet",), ("a_1_2.parquet",), (None,)], "name string")
    assert [r.trip_id for r in catalog.trip_ids(rows).collect()] == ["123", "tracks_1e+05.parquet", "2", None]
    assert catalog.trip_ids(rows.limit(0)).count() == 0


def test_new_ids_are_distinct_and_null_is_an_id(spark):
    wanted, stored = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id long"), spark.createDataFrame([(2,), (None,)], "id long")
    assert [r.id for r in incremental.new_ids(wanted, stored).collect()] == [1]


LISTED = [("a__v1__.parquet", 1), ("a__v2__.parquet", 2), ("a__v3__.parquet", 2), ("b__v1__.parquet", 1), ("a__v9__.csv", 9), ("noversion.parquet", 9)]


def listing(spark):
    return spark.createDataFrame([(n, datetime(2024, 1, d)) for n, d in LISTED], "name string, updated timestamp")


def test_latest_keeps_ties(spark):
    found = {r.name for r in catalog.resolve(listing(spark), extension="parquet").collect()}
    assert found == {"a__v2__.parquet", "a__v3__.parquet", "b__v1__.parquet"}
    found = {r.name for r in catalog.resolve(listing(spark), "a", extension="parquet", exact_match=True).collect()}
    assert found == {"a__v2__.parquet", "a__v3__.parquet"}
    assert {r.name for r in catalog.resolve(listing(spark), version="v1").collect()} == {"a__v1__.parquet", "b__v1__.parquet"}


def test_versioned_names(spark):
    now = datetime(2024, 5, 6, 7, 8, 9)
    assert names.versioned("f", "parquet", "abcdef0123", now=now) == "f__20240506070809_abcdef0__.parquet"
    assert names.versioned("f", "", "", now=now) == "f__20240506070809__"
    with pytest.raises(ValueError):
        names.versioned("f", "csv", "a" * 40, length=41)
    row = spark.createDataFrame([(now,)], "t timestamp").select(names.versioned_column(F.lit("f"), F.col("t"), ".parquet", "abcdef0123").alias("n"))
    assert row.first().n == "f__20240506070809_abcdef0__.parquet"


def test_stored_order_and_missing_columns(spark):
    data = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert collection.in_order(data, ["b", "z", "a"]).columns == ["b", "z", "a", "c"]
    assert collection.in_order(data, ["b", "z", "a"]).first().z is None
    assert collection.in_order(data, None).columns == ["a", "b", "c"]
    kinds = spark.createDataFrame([("metadata",), (None,), ("x",)], "type string")
    assert collection.data_rows(kinds).count() == 2 and collection.metadata_rows(kinds).count() == 1


def test_push_replaces_and_pull_restores(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, type string")
    ran = []
    assert store.push(first, root, "things", "db", geo=True, run=ran.append)
    assert "2dsphere" in ran[0]
    assert store.push(spark.createDataFrame([("c", 3)], "type string, id int"), root, "things", "db", geo=True, run=lambda x: 1 / 0)
    back = store.pull(spark, root, "things", "db")
    assert back.columns == ["type", "id"] and [tuple(r) for r in back.collect()] == [("c", 3)]
    for hole in range(4):
        args = [first, root, "things", "db"]
        args[hole] = None
        with pytest.raises(ValueError):
            store.push(*args)


def test_latest_written_object_is_read(spark, tmp_path):
    root = str(tmp_path)
    assert store.read_latest(spark, root, "t") is None
    store.write_versioned(spark.range(1), root, "t", "aaaaaaa", datetime(2024, 1, 1))
    name = store.write_versioned(spark.range(5), root, "t", "bbbbbbb", datetime(2024, 1, 2))
    import os

    os.utime(f"{root}/{name}", (4_000_000_000, 4_000_000_000))
    assert store.read_latest(spark, root, "t").count() == 5
    assert store.read_latest(spark, root, "t", "20240101000000_aaaaaaa").count() == 1


def test_sheets_are_strings_and_names_are_checked(spark, tmp_path):
    (tmp_path / "devices.csv").write_text("state,IMEI\nInstalled,001\nInstalled,001\nRetired,2\n,3\n")
    with pytest.raises(ValueError, match="devices"):
        sheets.read_sheets(spark, str(tmp_path), ["devices"], "boats")
    tables = sheets.read_sheets(spark, str(tmp_path), ["devices"])
    assert [f.dataType.simpleString() for f in tables["devices"].schema] == ["string", "string"]
    assert incremental.device_list(tables["devices"]).first().imeis == "001"


def test_batches(spark):
    ids = spark.createDataFrame([(3,), (1,), (2,)], "id long")
    assert [r.id for r in incremental.batch(ids, 2).collect()] == [1, 2]
    assert incremental.batch(ids, None).count() == 3 and incremental.batch(ids, 9).count() == 3 and incremental.batch(ids, 0).count() == 0


def test_settings(tmp_path):
    file = tmp_path / "c.toml"
    (tmp_path / "s").write_text("hush\nmore\n")
    file.write_text(f'[default.api]\ntoken = "${{TOK}}"\nurl = "u"\n[b]\ninherits = "default"\n[b.api]\nsecret = "@{tmp_path}/s"\n[c]\ninherits = "gone"\n')
    got = read_config(file, "b", {"TOK": "t1"})
    assert got == {"api": {"token": "t1", "url": "u", "secret": "hush"}}
    assert redacted(got) == {"api": {"token": "***", "url": "u", "secret": "***"}}
    with pytest.raises(ValueError, match="gone"):
        read_config(file, "c", {})
    assert read_config(env={})["tracks"]["grid_size"] == 500
