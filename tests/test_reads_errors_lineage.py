"""Balanced reads, heads of files, rescued values and roots by doubling."""

import datetime as dt

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace import fs
from millrace.operators import columns as C
from millrace.operators import lineage
from millrace.operators.joins import exclude_quarantined
from millrace.plans.config import Ingestion
from millrace.plans.ingest import run_ingest
from millrace.sources import files as src
from millrace.sources import jdbc, targets


def skewed(spark, n=20_000):
    value = F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 4 == 0, F.lit(7)).otherwise(F.pow(F.col("id"), F.lit(3)).cast("bigint"))
    return spark.range(n).select(value.alias("c"))


def test_balanced_ranges_of_a_skewed_column(spark):
    df = skewed(spark)
    points = jdbc.depth_points(df, "c", 40)
    predicates = jdbc.depth_predicates("c", points)
    found = jdbc.partition_depths(df, "c", predicates).first()
    assert found["covered"] == 20_000 and found["astray"] == 0 and found["null_rows"] == 400
    counts = {p: df.where(p).count() for p in predicates}
    heavy = [p for p in predicates if " = " in p]
    assert heavy == ["c = 7"] and counts["c = 7"] > 4_000
    assert max(n for p, n in counts.items() if p not in (*heavy, "c IS NULL")) <= 2 * 20_000 / 40


def test_depth_query_in_a_database(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i % 10 = 0 THEN NULL ELSE i * i END AS c FROM range(1000) r(i)")
    found = con.execute(jdbc.depth_query("c", 8, table="t")).fetchall()
    predicates = jdbc.depth_predicates("c", [low for _, low in found][1:])
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(counts) == 1000 and counts[-1] == 100 and max(counts[:-1]) <= 2 * 900 / 8
    assert con.execute(jdbc.depth_query("c", 2, query="select c from t")).fetchall() == [(1, 1), (2, 501 * 501)]


@pytest.mark.parametrize("points, wanted", [
    ([], ["c IS NOT NULL", "c IS NULL"]),
    ([None, 3], ["c < 3", "c >= 3", "c IS NULL"]),
    ([3, 3, 3, 5], ["c < 3", "c = 3", "c > 3 AND c < 5", "c >= 5", "c IS NULL"]),
    (["a'b"], ["c < 'a''b'", "c >= 'a''b'", "c IS NULL"]),
    ([dt.date(2024, 1, 2)], ["c < DATE '2024-01-02'", "c >= DATE '2024-01-02'", "c IS NULL"]),
    ([dt.datetime(2024, 1, 2, 3, 4, 5, 6)], ["c < TIMESTAMP '2024-01-02 03:04:05.000006'", "c >= TIMESTAMP '2024-01-02 03:04:05.000006'", "c IS NULL"]),
])
def test_depth_predicates(points, wanted):
    assert jdbc.depth_predicates("c", points) == wanted


def test_only_heads_of_files_are_read(spark, tmp_path, monkeypatch):
    (tmp_path / "a").mkdir()
    for k in range(3):
        (tmp_path / "a" / f"{k}.csv").write_text("id;name;amount\n" + "".join(f"{i};n{i};{i}.5\n" for i in range(20_000)))
    (tmp_path / "a" / "_note").write_text("x,y\n1,2\n")
    seen, real = [], fs.head
    monkeypatch.setattr(fs, "head", lambda s, f, n: seen.append(len(found := real(s, f, n))) or found)
    assert src.sniff_files(spark, str(tmp_path / "a"), 50) == (";", True)
    assert len(seen) == 3 and max(seen) == (1 << 16) + 1
    (tmp_path / "a" / "z.csv").write_text("1,2\n3,4\n")
    with pytest.raises(ValueError, match="differ"):
        src.sniff_files(spark, str(tmp_path / "a"), 50)


def test_corrupt_lines_keep_their_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,v\n1,a\nx,b\n3,c,d\n")
    df = src.read_delimited(spark, str(tmp_path / "x.csv"), ",", True, "id int, v string", corrupt="_line").cache()
    assert rows(df) == [(1, "a", None), (3, "c", "3,c,d"), (None, "b", "x,b")]
    with pytest.raises(ValueError, match="schema"):
        src.read_delimited(spark, str(tmp_path / "x.csv"), ",", True, corrupt="_line")


RECORDS = [
    {"sequence_number": "1", "source_column_name": "k", "target_column_name": "id", "target_datatype": "int"},
    {"sequence_number": "2", "source_column_name": "v", "target_column_name": "price", "target_datatype": "decimal", "target_length": "6", "target_precision": "2"},
    {"sequence_number": "3", "source_column_name": "d", "target_column_name": "day", "target_datatype": "date"},
]
DATA = [("1", "2.50", "2024-01-01"), ("2", "x", "2024-01-01"), ("3", None, ""), ("z", "1", "soon"), ("5", "1", "2024-13-01"), ("6", " ", None)]


def test_rescued_values(spark):
    df = spark.createDataFrame(DATA, "k string, v string, d string")
    good, bad = C.split_rescued(C.typed_rescue(df, RECORDS))
    assert good.columns == ["id", "price", "day"] and rows(good, "id") == [(1,), (3,), (6,)]
    assert rows(C.typed_select(df, RECORDS)) == rows(C.typed_rescue(df, RECORDS).drop(C.RESCUED))
    assert rows(C.error_records(bad, "t", ["id"])) == sorted([
        ("t", '{"id":2}', '{"v":"x"}'), ("t", None, '{"k":"z","d":"soon"}'), ("t", '{"id":5}', '{"d":"2024-13-01"}'),
    ], key=repr)


def test_a_run_sets_bad_rows_aside_and_the_quarantine_reads_them(spark, tmp_path):
    spec = Ingestion.from_record({"pipeline_id": "p", "load_type": "delta", "target_file_name": "t", "primary_key_set": "['id']", "pipeline_columns": RECORDS})
    errors = str(tmp_path / "errors")
    given = spark.createDataFrame(DATA, "k string, v string, d string")
    for day in (1, 2, 2):
        done = run_ingest(spark, spec, str(tmp_path), dt.datetime(2024, 1, day), source=given, errors=errors)
    assert (done.log["landing_count"], done.log["processed_count"], done.log["final_count"]) == (6, 3, 3)
    assert targets.partition_values(spark, errors, "load_dt") == ["2024-01-01", "2024-01-02"]
    latest = targets.read_latest_partition(spark, errors, "load_dt")
    assert latest.count() == 3
    others = spark.createDataFrame([(1,), (2,), (5,), (None,)], "id int")
    assert rows(exclude_quarantined(others, latest, "t", "id")) == [(1,), (None,)]
    assert exclude_quarantined(others, latest, "another", "id").count() == 4


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    staged, real = [], lineage.stage
    monkeypatch.setattr(lineage, "stage", lambda df, label: staged.append(label) or real(df, label))
    chain = spark.range(4096).select(F.concat(F.lit("n"), F.col("id") + 1).alias("target"), F.concat(F.lit("n"), "id").alias("source"))
    found = lineage.root_sources(chain)
    assert found.count() == 4096 and [r["root"] for r in found.select("root").distinct().collect()] == ["n0"]
    assert staged.count("lineage-jumps") <= 13


def test_cycles_end_and_every_root_is_found(spark):
    import random

    rng = random.Random(3)
    for size in (1, 5, 12):
        edges = [(f"a{k}", f"a{rng.randrange(size + 4)}") for k in range(size) for _ in range(2)] + [("a0", None)]
        df = spark.createDataFrame(edges, "target string, source string")
        above = {}
        for t, s in edges:
            above.setdefault(t, set()).add(s)
        wanted = set()
        for t in above:
            seen, todo = set(), [t]
            while todo:
                for s in above.get(todo.pop(), ()):
                    if s is not None and s not in seen:
                        seen.add(s)
                        todo.append(s)
            wanted |= {(t, s) for s in seen if s not in above}
        found = {(r["target"], r["root"]) for r in lineage.root_sources(df).where("root IS NOT NULL").collect()}
        assert found == wanted
    assert rows(lineage.root_sources(df, "a0").select("target").distinct()) == [("a0",)]


def test_json_schema_of_nested_and_conflicting_types(spark):
    texts = ['{"a":1,"b c":{"x":[1,2.5,"s"],"VARIANT":null},"d":true}', '{"a":"t","b c":{"x":[]},"f":1.5,"g":[{"h":1}]}', "{bad", None, '{"f":3,"i":1e300,"OBJECT":7}']
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, v string")
    found = src.json_records(df, "v", corrupt="wrong")
    kinds = dict(found.dtypes)
    assert kinds["b c"] == "struct<VARIANT:string,x:array<string>>" and kinds["g"] == "array<struct<h:bigint>>"
    assert (kinds["a"], kinds["d"], kinds["f"], kinds["i"], kinds["OBJECT"]) == ("string", "boolean", "double", "double", "bigint")
    by_key = {r["k"]: r.asDict(True) for r in found.collect()}
    assert [by_key[k]["a"] for k in range(5)] == ["1", "t", None, None, None] and by_key[4]["f"] == 3.0
    assert [by_key[k]["wrong"] for k in range(5)] == [None, None, "{bad", None, None]
    assert by_key[0]["b c"]["x"] == ["1", "2.5", "s"] and by_key[1]["g"] == [{"h": 1}]


def test_json_without_objects(spark):
    df = spark.createDataFrame([(1, "[1]"), (2, None)], "k int, v string")
    assert src.json_records(df, "v").columns == ["k"] and src.json_records(df.limit(0), "v").count() == 0


def test_dedup_state_leaves(spark, tmp_path):
    """Two deliveries of each part of the data, parts in order of time, with a delay far shorter than the data."""
    from millrace.queries import io

    base = str(tmp_path)
    events = spark.range(2_000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts"))
    out = io.replay_twice(events, base, "ts", "event_id", "10 minutes", 4)
    assert rows(out) == rows(events)
    state = spark.read.format("statestore").load(f"{base}/checkpoint")
    assert 0 < state.count() <= 20


def test_a_run_records_its_lineage(spark, tmp_path):
    spec = Ingestion.from_record({
        "pipeline_id": "p", "load_type": "delta", "target_file_name": "t", "primary_key_set": "['id']", "pipeline_columns": RECORDS, "source_table_name": "shop.orders",
    })
    log = lineage.LineageLog("load", "sales")
    given = spark.createDataFrame([("1", "2.5", "2024-01-01", "extra")], "k string, v string, d string, w string")
    run_ingest(spark, spec, str(tmp_path), dt.datetime(2024, 1, 1), source=given, lineage=log)
    run_ingest(spark, spec, str(tmp_path), dt.datetime(2024, 1, 2), source=given.limit(0), lineage=log)  # nothing to store
    assert [(e["transformation_func_nm"], e["target_tables"]) for e in log.events] == [("typed_select", "t_typed"), ("upsert", "t"), ("Final", "t")]
    assert log.events[0]["dropped_cols"] == ["w"] and log.events[1]["key_cols"] == ["id"]
    log.save(spark, str(tmp_path / "lineage"))
    edges = lineage.edges_of(spark.read.parquet(str(tmp_path / "lineage")))
    assert set(rows(lineage.root_sources(edges))) == {("t_typed", "shop.orders"), ("t", "shop.orders")}
