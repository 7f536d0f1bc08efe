"""Append and ledger merges on small literal tables."""

import pytest
from pyspark.sql import functions as F

from tablelog import SchemaDrift, Vocabulary, append_merge, ledger_merge, merge_strategy
from tests.conftest import final_plan, ordered, rows, ts

HISTORY = "system_time timestamp, event_time timestamp, id int, data string"
BATCH = "event_time timestamp, id int, data string"
WIDE = "event_time timestamp, id int, extra string, data string"

# Readings of meters: two are stored, a later file repeats them and brings three more.
SEEN = [(ts(9), ts(2), 40, "low"), (ts(9), ts(4), 41, "high")]
DUMP = [(ts(2), 40, "low"), (ts(4), 41, "mid"), (ts(5), 42, "off"), (ts(7), 45, "high"), (ts(8), 47, "low")]
NEW = [(ts(11), *r) for r in DUMP[2:]]

# One plan for small batches, one for large.
LEDGER_PLANS = [{}, {"broadcast_bytes": 0}]


METERED = "meter int, unit string, read_at timestamp, kwh double"


def test_append_stamps_every_row(spark):
    """A first file: all of it, repeated readings too, behind the time it was taken in."""
    readings = [(7, "W", ts(3), 0.5), (7, "W", ts(3), 0.5), (None, "W", ts(4), None), (8, "kW", None, 12.25)]
    out = append_merge(None, spark.createDataFrame(readings, METERED), system_time=ts(30))
    assert out.columns == ["system_time", "meter", "unit", "read_at", "kwh"]
    assert rows(out) == ordered([(ts(30), *r) for r in readings])


def test_append_looks_at_no_key(spark):
    """A later file repeats stored readings; they are new rows all the same, and stored ones are not given out."""
    out = append_merge(spark.createDataFrame(SEEN, HISTORY), spark.createDataFrame(DUMP + DUMP[:1], BATCH), system_time=ts(12))
    assert rows(out) == ordered([(ts(12), *r) for r in DUMP + DUMP[:1]])


def test_append_takes_columns_in_the_order_of_the_history(spark):
    """A file with a column more, in an order of its own: known columns first, then the new one."""
    prev = spark.createDataFrame([(ts(9), 7, 0.5)], "system_time timestamp, meter int, kwh double")
    out = append_merge(prev, spark.createDataFrame([(2.5, "kW", 8), (3.5, None, 7)], "kwh double, unit string, meter int"), system_time=ts(13))
    assert out.columns == ["system_time", "meter", "kwh", "unit"]
    assert rows(out) == ordered([(ts(13), 8, 2.5, "kW"), (ts(13), 7, 3.5, None)])


def test_append_keeps_the_type_of_a_column_that_went(spark):
    """A file without the unit and the time of reading: NULLs of the history's types, so that files read together."""
    prev = spark.createDataFrame([(ts(9), 7, "W", ts(3), 0.5)], "system_time timestamp, " + METERED)
    out = append_merge(prev, spark.createDataFrame([(0.25, 9)], "kwh double, meter int"), system_time=ts(14))
    assert [f.dataType.simpleString() for f in out.schema] == ["timestamp", "int", "string", "timestamp", "double"]
    assert rows(out) == ordered([(ts(14), 9, None, None, 0.25)])


def test_append_reads_no_history_rows(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.createDataFrame(SEEN, HISTORY).write.parquet(path)
    out = append_merge(
        spark.read.parquet(path), spark.createDataFrame(DUMP, BATCH), system_time=ts(11)
    )
    assert "FileScan" not in out._jdf.queryExecution().toString()


def test_reserved_column(spark):
    df = spark.createDataFrame([(ts(0), 1)], "System_Time timestamp, id int")
    with pytest.raises(ValueError, match="already contains"):
        append_merge(None, df, system_time=ts(1))
    own = Vocabulary(system_time="seen_at")
    assert append_merge(None, df, system_time=ts(1), vocab=own).columns[0] == "seen_at"


def test_ledger_from_empty(spark):
    batch = DUMP[:3]
    out = ledger_merge(None, spark.createDataFrame(batch, BATCH), key=["ID"], system_time=ts(3))
    assert rows(out) == ordered([(ts(3), *b) for b in batch])


@pytest.mark.parametrize("plan", LEDGER_PLANS)
def test_ledger_append(spark, plan):
    out = ledger_merge(
        spark.createDataFrame(SEEN, HISTORY),
        spark.createDataFrame(DUMP, BATCH),
        key=["id"],
        system_time=ts(11),
        **plan,
    )
    assert out.columns == ["system_time", "event_time", "id", "data"]
    assert rows(out) == ordered(NEW)


@pytest.mark.parametrize("plan", LEDGER_PLANS)
def test_ledger_added_column(spark, plan):
    batch = [(t, i, "xyz"[i % 3], d) for t, i, d in DUMP]
    out = ledger_merge(
        spark.createDataFrame(SEEN, HISTORY),
        spark.createDataFrame(batch, WIDE),
        key=["id"],
        system_time=ts(11),
        **plan,
    )
    assert out.columns == ["system_time", "event_time", "id", "data", "extra"]
    assert rows(out) == ordered([(*n, "xyz"[n[2] % 3]) for n in NEW])


@pytest.mark.parametrize("plan", LEDGER_PLANS)
def test_ledger_removed_column(spark, plan):
    prev = spark.createDataFrame(
        [(s, e, i, "x", d) for s, e, i, d in SEEN], "system_time timestamp, " + WIDE
    )
    out = ledger_merge(
        prev, spark.createDataFrame(DUMP, BATCH), key=["id"], system_time=ts(11), **plan
    )
    assert out.columns == ["system_time", "event_time", "id", "extra", "data"]
    assert rows(out) == ordered([(s, e, i, None, d) for s, e, i, d in NEW])


@pytest.mark.parametrize("plan", LEDGER_PLANS)
def test_ledger_keeps_duplicates_and_matches_null_keys(spark, plan):
    prev = spark.createDataFrame(
        [(ts(0), None, 1, "a"), (ts(0), "k", None, "b")],
        "system_time timestamp, k string, n int, v string",
    )
    curr = spark.createDataFrame(
        [(None, 1, "z"), ("k", None, "z"), (None, None, "q"), ("", 1, "e"), ("", 1, "e"), ("k", 0, "f")],
        "k string, n int, v string",
    )
    out = ledger_merge(prev, curr, key=["k", "n"], system_time=ts(1), **plan)
    expected = [(None, None, "q"), ("", 1, "e"), ("", 1, "e"), ("k", 0, "f")]
    assert rows(out, "k", "n", "v") == ordered(expected)


@pytest.mark.parametrize("plan", LEDGER_PLANS)
def test_ledger_twice_adds_nothing(spark, plan):
    curr = spark.createDataFrame(DUMP, BATCH)
    first = ledger_merge(None, curr, key=["id"], system_time=ts(11))
    assert rows(ledger_merge(first, curr, key=["id"], system_time=ts(7), **plan)) == []


@pytest.mark.parametrize("plan", LEDGER_PLANS)
def test_ledger_hot_key(spark, plan):
    """A third of the batch, and of the history, share one key; every row counts."""
    curr = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    other = spark.range(900).select(
        F.lit(ts(0)).alias("system_time"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    out = ledger_merge(other, curr, key=["k"], system_time=ts(1), **plan)
    known = {1} | {i for i in range(900) if i % 3}
    expected = [(-1 if i % 3 == 0 else i, i) for i in range(3000)]
    assert rows(out, "k", "v") == ordered([r for r in expected if r[0] not in known])
    copies = curr.select("k", F.lit(7).alias("v"))
    out = ledger_merge(other, copies, key=["k"], system_time=ts(1), **plan)
    assert out.filter("k = -1").count() == 1000


def test_ledger_heavy_keys(spark, large):
    """History keys are distinct per task before the exchange; a heavy batch key is split at runtime."""
    lines = spark.range(60000)
    history = lines.select(
        F.lit(ts(0)).alias("system_time"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v")
    )
    curr = lines.select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        out = ledger_merge(history, curr.repartition(8), key=["k"], system_time=ts(1), broadcast_bytes=0)
        plan = final_plan(out)
        assert out.filter("k = -1").count() == 30000
        assert out.filter("k > 0").count() == sum(i % 2 and i % 3 == 0 for i in range(60000))
    finally:
        for name in small:
            spark.conf.unset(name)
    assert "skew=true" in plan and "LeftAnti" in plan
    # Below the exchange of the history stands a partial aggregate.
    assert plan.count("HashAggregate(keys=[__key0") == 2


def test_ledger_struct_key(spark):
    kind = "k struct<a:int,b:string>, v int"
    prev = spark.createDataFrame([((1, None), 1), (None, 2)], kind).withColumn("system_time", F.lit(ts(0)))
    curr = spark.createDataFrame([((1, None), 5), (None, 6), ((None, None), 7)], kind)
    out = ledger_merge(prev, curr, key=["k"], system_time=ts(1))
    assert [r["v"] for r in out.collect()] == [7]


def test_ledger_reads_only_keys_of_history(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.createDataFrame(SEEN, HISTORY).write.parquet(path)
    for plan in LEDGER_PLANS:
        out = ledger_merge(
            spark.read.parquet(path),
            spark.createDataFrame(DUMP, BATCH),
            key=["id"],
            system_time=ts(11),
            **plan,
        )
        plan_text = out._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<id:int>" in plan_text


def test_type_drift(spark):
    prev = spark.createDataFrame([(ts(0), 1, 1.0)], "system_time timestamp, id bigint, v double")
    ok = spark.createDataFrame([(2, 3)], "id int, v int")
    out = append_merge(prev, ok, system_time=ts(1))
    assert out.schema["id"].dataType.simpleString() == "bigint"
    assert out.schema["v"].dataType.simpleString() == "double"
    for bad in ("id string, v double", "id bigint, v bigint", "id bigint, v string"):
        df = spark.createDataFrame([], bad)
        with pytest.raises(SchemaDrift):
            append_merge(prev, df, system_time=ts(1))


def test_factory(spark):
    curr = spark.createDataFrame(DUMP, BATCH)
    prev = spark.createDataFrame(SEEN, HISTORY)
    assert merge_strategy("append")(prev, curr, system_time=ts(11)).count() == 5
    assert merge_strategy("ledger", key=["id"])(prev, curr, system_time=ts(11)).count() == 3
    renamed = curr.withColumnRenamed("event_time", "at")
    out = merge_strategy("snapshot", key=["id"])(None, renamed, system_time=ts(11))
    # Without an event time the system time stands in.
    assert out.select("event_time").distinct().collect() == [(plain_ts(11),)]
    with pytest.raises(NotImplementedError):
        merge_strategy("upsert")
    with pytest.raises(ValueError):
        merge_strategy("ledger")


def plain_ts(n):
    return ts(n).replace(tzinfo=None)
