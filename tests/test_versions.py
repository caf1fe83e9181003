"""Copy-on-write tables: only files with a changed key are written anew."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace import fs
from millrace.plans.config import Ingestion
from millrace.plans.ingest import run_ingest
from millrace.sinks import versions as V


def stored(spark, path, n=20_000, files=200):
    table = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    V.write_version(table, path, "k", files=files)
    return V.find_version(spark, path)


def file_names(spark, version):
    return {r["file"] for r in version.files(spark).collect()}


def changes(spark, *found):
    return spark.createDataFrame(list(found), "k bigint, v bigint, op string")


def test_one_key_of_many_files_rewrites_one_file(spark, tmp_path):
    path = str(tmp_path / "t")
    first = stored(spark, path)
    before = file_names(spark, first)
    assert len(before) == 200
    second = V.merge_version(spark, path, changes(spark, (777, 99, "UPD")), "op")
    after = file_names(spark, second)
    assert len(before - after) == 1 and len(after - before) == 1
    read = V.read_version(spark, path)
    assert read.count() == 20_000 and rows(read.where("k = 777")) == [(777, 99)]
    assert rows(V.read_version(spark, path, first.number).where("k = 777")) == [(777, 0)]
    third = V.upsert_version(spark, path, changes(spark, (5, 50, ""), (19_999, 51, ""), (30_000, 52, "")).drop("op"))
    assert len(after - file_names(spark, third)) == 2
    assert set(rows(V.read_version(spark, path).where("v >= 50"))) == {(5, 50), (777, 99), (19_999, 51), (30_000, 52)}


def test_deletes_inserts_and_changes_without_effect(spark, tmp_path):
    path = str(tmp_path / "t")
    before = file_names(spark, stored(spark, path, 100, 10))
    V.merge_version(spark, path, changes(spark, (3, 0, "DEL"), (500, 1, "INS"), (4, 9, None)), "op")
    found = {r["k"]: r["v"] for r in V.read_version(spark, path).collect()}
    assert len(found) == 100 and 3 not in found and found[500] == 1 and found[4] == 4
    V.merge_version(spark, path, changes(spark, (-1, 0, "DEL")), "op")
    assert len(before - file_names(spark, V.find_version(spark, path))) == 1
    V.append_version(spark.createDataFrame([(3, 3)], "k bigint, v bigint"), path)
    assert rows(V.read_version(spark, path).where("k = 3")) == [(3, 3)]
    assert V.read_version(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        V.append_version(V.read_version(spark, path), str(tmp_path / "none"))


def test_a_run_that_stops_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored(spark, path, 100, 5)
    real = fs.create
    monkeypatch.setattr(fs, "create", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        V.merge_version(spark, path, changes(spark, (1, 77, "UPD")), "op")
    monkeypatch.setattr(fs, "create", real)
    assert rows(V.read_version(spark, path).where("k = 1")) == [(1, 1)]
    fs.create(spark, f"{path}/versions/{2:020d}.json", b'{"manifest": ')  # a pointer cut off by a crash
    assert V.find_version(spark, path).number == 1
    assert V.merge_version(spark, path, changes(spark, (1, 77, "UPD")), "op").number == 3
    assert rows(V.read_version(spark, path).where("k = 1")) == [(1, 77)]
    removed = V.clean_versions(spark, path)
    assert len(removed) >= 2 and V.read_version(spark, path).count() == 100
    assert V.numbers(spark, path) == [3] and V.clean_versions(spark, path) == []


def test_two_runs_on_one_version_conflict(spark, tmp_path):
    path = str(tmp_path / "t")
    base = stored(spark, path, 50, 2)
    V.upsert_version(spark, path, changes(spark, (1, 5, "")).drop("op"))
    with pytest.raises(V.ConflictError):
        V.commit(spark, path, base, base.files(spark), base.keys, base.schema)
    assert not fs.create(spark, f"{path}/versions/{2:020d}.json", b"{}")


def test_null_text_and_several_keys(spark, tmp_path):
    path = str(tmp_path / "t with space")
    at = dt.datetime(2024, 1, 1)
    data = [("a", 1, at), ("a", 2, at), (None, 1, at), ("ü", None, at)] + [("hot", k, at) for k in range(300)]
    table = spark.createDataFrame(data, "k string, n int, t timestamp_ntz")
    before = file_names(spark, V.write_version(table, path, ["k", "n"], files=8))
    new = spark.createDataFrame([(None, 1, None), ("hot", 7, None), ("ü", None, None)], table.schema)
    second = V.upsert_version(spark, path, new)
    assert rows(V.read_version(spark, path).where("t IS NULL"), "k", "n") == sorted([(None, 1), ("hot", 7), ("ü", None)], key=repr)
    assert V.read_version(spark, path).count() == len(data) and before & file_names(spark, second)
    empty = spark.createDataFrame([], table.schema)
    V.write_version(empty, str(tmp_path / "e"), ["k", "n"])
    assert V.read_version(spark, str(tmp_path / "e")).count() == 0
    V.upsert_version(spark, str(tmp_path / "e"), new)
    assert V.read_version(spark, str(tmp_path / "e")).count() == 3


def test_ingestion_into_a_versioned_table(spark, tmp_path):
    columns = [
        {"sequence_number": "1", "source_column_name": "k", "target_column_name": "id", "target_datatype": "int"},
        {"sequence_number": "2", "source_column_name": "v", "target_column_name": "val", "target_datatype": "string"},
    ]
    record = {"pipeline_id": "p", "load_type": "delta", "target_file_name": "t", "primary_key_set": "['id']", "pipeline_columns": columns}
    load = lambda day, data, **more: run_ingest(
        spark, Ingestion.from_record({**record, **more}), str(tmp_path), dt.datetime(2024, 1, day), source=spark.createDataFrame(data, "k string, v string"), versioned=True
    )
    load(1, [(str(k), "a") for k in range(100)])
    done = load(2, [("5", "b"), ("200", "c")])
    assert done.log["final_count"] == 101
    assert set(rows(V.read_version(spark, done.final_path).where("val <> 'a'"))) == {(5, "b"), (200, "c")}
    assert load(3, []).written is False and V.find_version(spark, done.final_path).number == 2
    load(4, [("1", "z")], load_type="full")
    assert rows(V.read_version(spark, done.final_path)) == [(1, "z")] and V.read_version(spark, done.final_path, 2).count() == 101
    with pytest.raises(ValueError, match="needs keys"):
        load(5, [("1", "z")], primary_key_set="")
