"""Every registered query against its SQL on the small tables."""

import datetime as dt
import json
import os

import pytest

import __spark_entry__ as entry_point
from workload import ORACLES, QUERIES, files

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def canonical(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    text = lambda v: v.isoformat(" ") if isinstance(v, dt.datetime) else repr(v)
    return [names[i] for i in order], sorted(tuple(text(t[i]) for i in order) for t in tuples)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLES[name])
    expected = canonical([d[0] for d in result.description], result.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]
    if name != "snapshot_no_change_count":
        assert got[1]


@pytest.mark.parametrize("name, purpose, least", [("geojson_all_types", "collections", 3), ("geojson_split", "split", 2)])
def test_each_collection_is_a_file(spark, tmp_path, monkeypatch, name, purpose, least):
    spark.createDataFrame([(i, f"s{i}", i % 25) for i in range(200)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(files, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    # Partitions as of a large table.
    monkeypatch.setattr(files, "_MOST_FEATURES", {"collections": 30, "split": 30}, raising=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = sorted(int(r["key"]) for r in QUERIES[name](spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == list(range(200))
    texts = [p.read_text() for p in (tmp_path / purpose).rglob("part-*")]
    sizes = [len(json.loads(t)["features"]) for t in texts]
    assert sum(sizes) == 200 and len(sizes) == 7 > least and max(sizes) < 60


def test_streamed_files_are_written_side_by_side(spark, tmp_path, monkeypatch):
    data = [(i, dt.datetime(2024, 1, 1 + i % 9), i % 40, "view", 0.5, "{}") for i in range(300)]
    kind = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(data, kind).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(files, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    got = QUERIES["stream_ledger_state"](spark, str(tmp_path))
    batch = {i: 0 if i % 9 < 2 else 1 if i % 9 < 5 else 2 for i in range(300)}
    least = {}
    for i in range(300):
        least[i % 40] = min(batch[i], least.get(i % 40, 2))
    assert sorted(r["event_id"] for r in got.collect()) == [i for i in range(300) if batch[i] == least[i % 40]]
    assert len(list((tmp_path / "states" / "raw").glob("part-*"))) > 2


def test_entry(spark):
    df = entry_point.entry(spark)
    assert {r["observed"] for r in df.select("observed").distinct().collect()} == {"I", "U", "D"}
