"""Declared functions, shared steps, and tables side by side."""

import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import tablelog.plans.ingest as ingest_module
from tablelog import CorruptRecords, IngestTask, Source, SqlFunction, ingest, ingest_tables, preprocess, read_history
from tests.conftest import final_plan, rows, ts

HALF = SqlFunction("half", "x INT", "INT", "x div 2")
PARTS = SqlFunction("parts_of", "top INT", "TABLE (n INT)", "SELECT n FROM VALUES (1), (2), (5) AS t(n) WHERE n <= top")


def csv(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_declared_functions(spark, tmp_path):
    source = Source(
        options={"header": "true"},
        schema=("id INT",),
        functions=(HALF, PARTS),
        preprocess=(("select id, half(id) as h, p.n from input, lateral parts_of(id) p where p.n <= half(id)", None),),
    )
    task = IngestTask("t", source, csv(tmp_path / "a.csv", ["id", "5", "2"]), str(tmp_path / "d"), str(tmp_path / "l"), ts(0))
    ingest(spark, task)
    assert rows(read_history(spark, task.data_dir, task.log_dir), "id", "h", "n") == [(2, 1, 1), (5, 2, 1), (5, 2, 2)]
    # They end with the task's session.
    with pytest.raises(AnalysisException):
        spark.sql("select half(3)")
    own = spark.newSession()
    HALF.declare(own)
    # The optimizer puts the body in place of the call.
    assert "half(" not in own.range(3).selectExpr("half(cast(id as int)) as x")._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(AnalysisException):
        HALF.declare(own)


STEPS = [
    ("select id % 10 as k, sum(id) as total from input group by id % 10", "sums"),
    ("select max(total) as top from sums where k > 3", "best"),
    ("select s.k, s.total from sums s join best b on s.total = b.top", None),
]


def test_steps_read_twice_run_once(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.range(100).write.parquet(path)
    assert final_plan(preprocess(spark.read.parquet(path), STEPS)).count("FileScan") == 2
    shared = []
    out = preprocess(spark.read.parquet(path), STEPS, shared=shared)
    assert len(shared) == 1 and shared[0].columns == ["k", "total"]  # ``input`` is read once for it
    plan = final_plan(out)
    assert "InMemoryTableScan" in plan and plan.count("FileScan") == 1
    assert rows(out) == [(9, 540)]
    for frame in shared:
        frame.unpersist()
    # Nothing is kept that is read once.
    shared = []
    preprocess(spark.read.parquet(path), STEPS[:1] + [("select * from sums", None)], shared=shared)
    assert shared == []
    preprocess(spark.read.parquet(path), [("select * from input union all select * from input", "output")], shared=shared)
    assert [f.columns for f in shared] == [["id"]]
    shared[0].unpersist()


def test_shared_steps_are_released(spark, tmp_path, monkeypatch):
    held = []
    plain = ingest_module.preprocess

    def seen(df, steps, engine, shared):
        out = plain(df, steps, engine, shared)
        held.extend(shared)
        assert [f.storageLevel.useMemory for f in shared] == [True] * len(shared)
        return out

    monkeypatch.setattr(ingest_module, "preprocess", seen)
    source = Source(options={"header": "true"}, schema=("id INT",), preprocess=tuple(STEPS))
    task = IngestTask("t", source, csv(tmp_path / "a.csv", ["id", "5", "15", "2"]), str(tmp_path / "d"), str(tmp_path / "l"), ts(0))
    ingest(spark, task)
    assert len(held) == 1 and not held[0].storageLevel.useMemory
    assert rows(read_history(spark, task.data_dir, task.log_dir), "k", "total") == [(5, 20)]


def test_tables_side_by_side(spark, tmp_path):
    source = Source(options={"header": "true"}, schema=("id INT", "v STRING"), merge="snapshot", merge_params={"key": ["id"]})

    def task(table, step, lines):
        path = csv(tmp_path / f"{table}{step}.csv", ["id,v", *lines])
        return IngestTask(table, source, path, str(tmp_path / table / "d"), str(tmp_path / table / "l"), ts(step))

    meet = threading.Barrier(2, timeout=60)  # only tables that run at one time pass
    waiting = Source(options={"header": "true"}, schema=("id INT", "v STRING"), merge="snapshot", merge_params={"key": ["id"]}, setup=lambda s: meet.wait())
    first = [task("a", 0, ["1,x"]), task("b", 0, ["1,x"])]
    first = [IngestTask(**{**t.__dict__, "source": waiting}) for t in first]
    tasks = [*first, task("a", 1, ["1,y"]), task("b", 1, ["oops,y"]), task("b", 2, ["2,z"]), task("a", 2, ["2,z"])]
    done = {o.data_dir.split("/")[-2]: o for o in ingest_tables(spark, tasks, at_once=2)}
    assert [r.num_records for r in done["a"].records] == [1, 1, 2] and done["a"].error is None
    assert [r.sequence for r in done["a"].records] == [1, 2, 3]
    assert len(done["b"].records) == 1 and isinstance(done["b"].error, CorruptRecords)
    assert done["b"].failed is tasks[3] and done["b"].left == (tasks[4],)
    assert rows(read_history(spark, tasks[0].data_dir, tasks[0].log_dir), "observed", "id").count(("U", 1)) == 1
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert ingest_tables(spark, []) == []
