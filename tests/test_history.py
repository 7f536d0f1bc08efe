"""Commits, the log, schema growth on disk, digests and the whole ingest."""

import logging
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tablelog.sources.history as history_module
from tablelog import (
    CorruptRecords,
    IngestTask,
    PastEventTime,
    Source,
    as_of,
    commit,
    dataset_digest,
    ingest,
    ingest_all,
    poll,
    preprocess,
    read_history,
    read_log,
)
from tablelog.functions.columns import SchemaDrift
from tablelog.operators.strategy import merge_strategy
from tablelog.sources.history import OtherInput, open_log
from tablelog.streaming.polling import commit_batch
from tests.conftest import ordered, rows, ts


@pytest.fixture
def dirs(tmp_path):
    return {"data_dir": str(tmp_path / "data"), "log_dir": str(tmp_path / "log")}


def test_commit_and_read(spark, dirs):
    assert read_history(spark, **dirs) is None
    assert read_log(spark, dirs["log_dir"]) is None
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    record = commit(df, **dirs, system_time=ts(0), commit_id="c1")
    assert (record.num_records, record.sequence, record.prev_block_hash) == (2, 1, "")
    assert record.interval_start == record.interval_end == record.system_time
    assert record.hash == dataset_digest(df).first()["hash"]
    assert rows(read_history(spark, **dirs)) == ordered([(1, "a"), (2, None)])
    # Data alone, without the log, is an ordinary Parquet table.
    assert rows(read_history(spark, dirs["data_dir"])) == ordered([(1, "a"), (2, None)])


def test_commit_is_idempotent(spark, dirs):
    df = spark.createDataFrame([(1,)], "id int")
    first = commit(df, **dirs, system_time=ts(0), commit_id="c1")
    again = commit(df.union(df), **dirs, system_time=ts(5), commit_id="c1")
    assert again == first
    assert read_history(spark, **dirs).count() == 1
    with pytest.raises(ValueError):
        commit(df, **dirs, system_time=ts(0), commit_id="../c")


def test_unrecorded_commit_is_not_read_and_is_replaced(spark, dirs):
    """What a job leaves behind when it dies between data and record."""
    df = spark.createDataFrame([(1,)], "id int")
    commit(df, **dirs, system_time=ts(0), commit_id="c1")
    spark.range(5).selectExpr("cast(id as int) id").write.parquet(dirs["data_dir"] + "/__commit=c2")
    assert read_history(spark, **dirs).count() == 1
    commit(spark.createDataFrame([(7,)], "id int"), **dirs, system_time=ts(1), commit_id="c2")
    assert rows(read_history(spark, **dirs)) == [(1,), (7,)]


def test_empty_commit(spark, dirs):
    df = spark.createDataFrame([], "id int, v string")
    record = commit(df, **dirs, system_time=ts(0), commit_id="c1")
    assert record.num_records == 0
    assert record.hash == dataset_digest(df).first()["hash"]
    assert read_history(spark, **dirs).columns == ["id", "v"]
    nothing = spark.range(10).filter("id < 0").selectExpr("cast(id as int) id")
    assert commit(nothing, **dirs, system_time=ts(0), commit_id="c2").num_records == 0


def test_output_files(spark, dirs, tmp_path):
    df = spark.range(100).repartition(4)
    commit(df, **dirs, system_time=ts(0), commit_id="many")
    commit(df, **dirs, system_time=ts(0), commit_id="few", coalesce=1)
    commit(df, **dirs, system_time=ts(0), commit_id="spread", repartition=2)
    count = lambda c: len(list((tmp_path / "data" / f"__commit={c}").glob("*.parquet")))
    assert (count("many"), count("few"), count("spread")) == (4, 1, 2)


def test_schema_growth_on_disk(spark, dirs):
    merge = merge_strategy("ledger", key=["id"])

    def add(step, data, schema):
        prev = read_history(spark, **dirs)
        out = merge(prev, spark.createDataFrame(data, schema), system_time=ts(step))
        commit(out, **dirs, system_time=ts(step), commit_id=f"c{step}")

    add(0, [(1, "a")], "id bigint, a string")
    add(1, [(2, "b", 5)], "id int, b string, n int")
    add(2, [(3, "A")], "id bigint, a string")
    expected = [(1, "a", None, None), (2, None, "b", 5), (3, "A", None, None)]
    assert rows(read_history(spark, **dirs), "id", "a", "b", "n") == ordered(expected)
    assert rows(read_history(spark, dirs["data_dir"]), "id", "a", "b", "n") == ordered(expected)


def test_flat_history_without_log(spark, tmp_path):
    """A plain Parquet directory, appended to, whose files differ in columns."""
    path = str(tmp_path / "flat")
    spark.createDataFrame([(1, "a")], "id int, a string").write.parquet(path)
    spark.createDataFrame([(2, "b")], "id int, b string").write.mode("append").parquet(path)
    assert rows(read_history(spark, path), "id", "a", "b") == ordered([(1, "a", None), (2, None, "b")])


def digest(df, **options):
    return tuple(dataset_digest(df, **options).first())


def test_digest(spark):
    df = spark.range(200).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"), F.lit(ts(0)).alias("t")
    )
    base = digest(df)
    assert base[1] == 200
    for same in (df.repartition(7), df.orderBy(F.desc("id")), df.select("t", "s", "id")):
        assert digest(same) == base
    # A row twice is not the same as none, nor is NULL the same as an empty text.
    assert digest(df.union(df.filter("id = 5")).union(df.filter("id = 5")))[0] != base[0]
    assert digest(df.fillna(""))[0] != base[0]
    later = df.withColumn("t", F.lit(ts(1)))
    assert digest(later)[0] != base[0]
    assert digest(later, exclude=["t"]) == digest(df, exclude=["t"])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert digest(df) == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_digest_separates_neighbouring_fields(spark):
    a = spark.createDataFrame([("ab", "c")], "x string, y string")
    b = spark.createDataFrame([("a", "bc")], "x string, y string")
    assert digest(a) != digest(b)


def test_preprocess_steps(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    steps = [
        ("select n, n % 2 as odd from input", "tagged"),
        ("select odd, sum(n) as total from tagged group by odd", "my sums"),
        ("select total from `my sums` where odd = 1", "output"),
        ("select broken from nowhere", None),
    ]
    assert preprocess(df, steps).collect() == [(25,)]
    # The views are gone, so the same names work again.
    assert preprocess(df, [("select count(*) from input", None)]).collect() == [(10,)]
    assert preprocess(df, []) is df
    assert not spark.catalog.tableExists("input") and not spark.catalog.tableExists("tagged")


def test_preprocess_errors(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="No step produces"):
        preprocess(df, [("select * from input", "a")])
    with pytest.raises(ValueError, match="Unsupported engine: flink"):
        preprocess(df, [("select 1", None)], engine="flink")
    with pytest.raises(ValueError, match="no engine"):
        preprocess(df, [("select 1", None)], engine=None)
    assert not spark.catalog.tableExists("input")


def test_preprocess_keeps_the_users_views(spark):
    spark.range(3).createOrReplaceTempView("input")
    try:
        with pytest.raises(Exception, match="already exists"):
            preprocess(spark.range(5), [("select * from input", None)])
        assert spark.table("input").count() == 3
    finally:
        spark.catalog.dropTempView("input")


def test_preprocess_passes_any_sql(spark):
    spark.udf.register("twice", lambda x: 2 * x, "bigint")
    df = spark.createDataFrame([(1, "a", '{"x": 3}'), (2, "a", '{"x": 4}')], "n bigint, g string, j string")
    steps = [
        ("select *, row_number() over (partition by g order by n) rn from input", "w"),
        ("select g, rn, cast(get_json_object(j, '$.x') as int) x, twice(n) d from w", "j"),
        ("select g, rn, sum(x) x, sum(d) d from j group by rollup(g, rn) except select 'a', 1, 3, 2", None),
    ]
    expected = [("a", 2, 4, 4), ("a", None, 7, 6), (None, None, 7, 6)]
    assert rows(preprocess(df, steps)) == ordered(expected)


def write_csv(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def task(dirs, path, step, source, **more):
    return IngestTask("t", source, path, **dirs, system_time=ts(2 * step + 1), **more)


def test_ingest_snapshots(spark, dirs, tmp_path):
    source = Source(
        format="csv",
        options={"header": "true"},
        schema=("id INT", "name STRING", "salary STRING"),
        preprocess=(("select id, name, cast(salary as int) salary from input", None),),
        merge="snapshot",
        merge_params={"key": ["id"]},
        coalesce=1,
    )
    files = [
        ["id,name,salary", "1,Alice,100", "2,Bob,80", "3,Charlie,120"],
        ["id,name,salary", "2,Bob,80", "3,Charlie,130", "4,Dan,100"],
        ["id,name,salary", "2,Bob,80", "3,Charlie,130", "4,Dan,100"],
    ]
    tasks = [
        task(dirs, write_csv(tmp_path / f"{i}.csv", lines), i, source, event_time=ts(2 * i))
        for i, lines in enumerate(files)
    ]
    records = ingest_all(spark, tasks)
    assert [r.num_records for r in records] == [3, 3, 0]
    assert [r.sequence for r in records] == [1, 2, 3]
    log = read_history(spark, **dirs)
    assert rows(log, "observed", "id", "salary") == ordered(
        [("I", 1, 100), ("I", 2, 80), ("I", 3, 120), ("D", 1, 100), ("U", 3, 130), ("I", 4, 100)]
    )
    assert rows(as_of(log, ["id"]), "id", "salary") == [(2, 80), (3, 130), (4, 100)]
    assert rows(as_of(log, ["id"], at=ts(1)), "id", "salary") == [(1, 100), (2, 80), (3, 120)]
    # Running the tasks again changes nothing.
    assert ingest_all(spark, tasks) == records
    with pytest.raises(PastEventTime):
        ingest(spark, task(dirs, tasks[0].data_to_ingest, 9, source, event_time=ts(0)))


@pytest.mark.parametrize(
    "more",
    [{}, {"persist": True}, {"preprocess": (("select id, n from input where n <> 'z'", None),)}],
)
def test_ingest_stops_at_corrupt_records(spark, dirs, tmp_path, more):
    source = Source(
        schema=("id INT", "n STRING", "extra INT"), merge="ledger", merge_params={"key": ["id"]}, **more
    )
    good = write_csv(tmp_path / "good.csv", ["1,x,1"])
    bad = write_csv(tmp_path / "bad.csv", ["2,y,1", "4,z,oops"])
    ingest(spark, task(dirs, good, 0, source))
    with pytest.raises(CorruptRecords, match="4,z,oops"):
        ingest(spark, task(dirs, bad, 1, source))
    assert rows(read_history(spark, **dirs), "id") == [(1,)]
    write_csv(tmp_path / "bad.csv", ["1,again,0", "2,y,0", "3,w,0"])
    assert ingest(spark, task(dirs, bad, 1, source)).num_records == 2


def test_ingest_inferred_names(spark, dirs, tmp_path):
    source = Source(options={"header": "true", "inferSchema": "true"})
    ingest(spark, task(dirs, write_csv(tmp_path / "a.csv", ["my id,a(b)", "1,x"]), 0, source))
    assert read_history(spark, **dirs).columns == ["system_time", "my_id", "a_b_"]


def test_ingest_geojson_and_archive(spark, dirs, tmp_path):
    text = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a b":1},"geometry":{"type":"Point","coordinates":[1,2]}}]}'
    (tmp_path / "a.geojson").write_text(text)
    ingest(spark, task(dirs, str(tmp_path / "a.geojson"), 0, Source(kind="geojson")))
    assert rows(read_history(spark, **dirs), "geometry", "a_b") == [("POINT (1 2)", "1")]

    import bz2, io, zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("x.txt", "p,1\nq,2")
        z.writestr("y.bin", "no")
    (tmp_path / "a.zip.bz2").write_bytes(bz2.compress(out.getvalue()))
    decode = lambda members: members.select(
        F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")
    )
    source = Source(kind="shapefile", sub_path_regex=r".*\.txt", decoder=decode)
    other = {k: v + "2" for k, v in dirs.items()}
    ingest(spark, task(other, str(tmp_path / "a.zip.bz2"), 0, source))
    assert rows(read_history(spark, **other), "line") == [("p,1",), ("q,2",)]


def test_ingest_nothing(spark, caplog):
    with caplog.at_level(logging.WARNING):
        assert ingest_all(spark, []) == []
    assert "Nothing to ingest" in caplog.text
    with pytest.raises(NotImplementedError):
        ingest(spark, IngestTask("t", Source(kind="kafka"), "x", "/nowhere/d", "/nowhere/l", ts(0)))


def test_polling(spark, dirs, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    schema = "id INT, v STRING"

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(str(raw))
        poll(
            stream,
            merge=merge_strategy("ledger", key=["id"]),
            **dirs,
            checkpoint=str(tmp_path / "checkpoint"),
            system_time=ts,
        ).awaitTermination()

    write_csv(raw / "a.csv", ["1,x", "2,y"])
    run()
    write_csv(raw / "b.csv", ["2,z", "3,w"])
    run()
    run()
    assert rows(read_history(spark, **dirs), "id", "v") == [(1, "x"), (2, "y"), (3, "w")]
    assert read_log(spark, dirs["log_dir"]).count() == 2


@pytest.mark.parametrize("kind", ["append", "snapshot"])
def test_replayed_batch(spark, dirs, kind):
    """A micro-batch delivered again, after it was recorded or only written, counts once."""
    merge = merge_strategy(kind, **({"key": ["id"]} if kind == "snapshot" else {}))
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    deliver = lambda n: commit_batch(batch, n, merge=merge, **dirs, system_time=ts, stream_id="s")
    deliver(0)
    deliver(0)
    assert read_history(spark, **dirs).count() == 2
    # Written, but the job died before the record.
    stale = read_history(spark, **dirs).withColumn("v", F.lit("stale"))
    stale.write.parquet(dirs["data_dir"] + "/__commit=batch-s-000000000001")
    deliver(1)
    assert read_history(spark, **dirs).filter("v = 'stale'").count() == 0
    assert read_history(spark, **dirs).count() == (4 if kind == "append" else 2)


def test_one_id_for_two_inputs_is_refused(spark, dirs):
    df = spark.range(2)
    commit(df, **dirs, system_time=ts(0), commit_id="c", source="a.csv")
    assert commit(df, **dirs, system_time=ts(0), commit_id="c", source="a.csv").sequence == 1
    with pytest.raises(OtherInput, match="a.csv"):
        commit(df, **dirs, system_time=ts(0), commit_id="c", source="b.csv")


def test_narrow_commits_and_changed_types(spark, dirs):
    commit(spark.createDataFrame([(1, "x")], "id bigint, v string"), **dirs, system_time=ts(0), commit_id="a")
    commit(spark.createDataFrame([(2,)], "id int"), **dirs, system_time=ts(1), commit_id="b")
    commit(spark.createDataFrame([(True, 3)], "new boolean, id bigint"), **dirs, system_time=ts(2), commit_id="c")
    assert rows(read_history(spark, **dirs), "id", "v", "new") == ordered([(1, "x", None), (2, None, None), (3, None, True)])
    with pytest.raises(SchemaDrift):
        commit(spark.createDataFrame([(4, 5)], "id bigint, v int"), **dirs, system_time=ts(3), commit_id="d")


def test_log_stays_short(spark, dirs, monkeypatch):
    monkeypatch.setattr(history_module, "TAIL", 4)
    for i in range(11):
        commit(spark.createDataFrame([(ts(i), i)], "event_time timestamp, n int"), **dirs, system_time=ts(i), commit_id=f"c{i}")
        log = open_log(spark, dirs["log_dir"])
        assert log.last == i + 1 and log.last_event_time() == (True, ts(i))
        files = read_log(spark, dirs["log_dir"]).inputFiles()
        assert len(files) <= 5
    assert read_history(spark, **dirs).count() == 11
    # Half a compaction is not read.
    (Path(dirs["log_dir"]) / "compact" / "upto=99").mkdir()
    assert open_log(spark, dirs["log_dir"]).last == 11


def test_batches_of_two_streams(spark, dirs):
    batch = spark.createDataFrame([(1, "x")], "id int, v string")
    for stream in ("one", "two", "one"):
        commit_batch(batch, 0, merge=merge_strategy("append"), **dirs, system_time=ts, stream_id=stream)
    assert read_history(spark, **dirs).count() == 2


def test_a_task_has_its_own_session(spark, dirs, tmp_path):
    """Views and options of the user and of other tasks do not meet."""
    (tmp_path / "a.csv").write_text("id\n1\n2\n")
    spark.createDataFrame([(9,)], "id int").createOrReplaceTempView("input")
    steps = (("set spark.sql.shuffle.partitions=3", "none"), ("select id, twice(id) as t from input", None))
    setup = lambda s: s.udf.register("twice", lambda x: 2 * int(x), "int")
    source = Source(options={"header": "true"}, preprocess=steps, setup=setup)
    ingest(spark, IngestTask("d", source, str(tmp_path / "a.csv"), **dirs, system_time=ts(0)))
    assert rows(read_history(spark, **dirs), "id", "t") == [("1", 2), ("2", 4)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert rows(spark.table("input")) == [(9,)]
    spark.catalog.dropTempView("input")
