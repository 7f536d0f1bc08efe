"""Ledger streams on the state store against the merge of each batch with the history."""

import datetime as dt
import random
import shutil
from decimal import Decimal

from pyspark.sql import functions as F

from tablelog import commit, ledger_merge, merge_strategy, poll, poll_ledger, read_history, read_log
from tests.conftest import rows, ts

KIND = "k int, j string, at timestamp, d decimal(20,3), big bigint, a array<int>, s struct<x: double>"
KEY = ["k", "j"]


def made(n, rng):
    return [
        (
            rng.choice([None, 1, 2, 3, 2**31 - 1]),
            rng.choice([None, "", "x", "ü"]),
            dt.datetime(2020, 1, 1, 0, 0, 0, rng.randrange(10**6)),
            Decimal(rng.randrange(10**9)) / 1000,
            2**53 + rng.randrange(9) if rng.random() < 0.8 else None,
            rng.choice([None, [], [1, None]]),
            rng.choice([None, (None,), (0.1,)]),
        )
        for _ in range(n)
    ]


def run(spark, base, raw, **more):
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(str(raw))
    poll_ledger(stream, key=KEY, data_dir=str(base / "d"), log_dir=str(base / "l"), checkpoint=str(base / "c"), system_time=ts, **more).awaitTermination()


def test_state_equals_merges_with_the_history(spark, tmp_path):
    rng = random.Random(3)
    raw, log = tmp_path / "raw", None
    stored = spark.createDataFrame(made(3, rng), KIND)
    for base in (tmp_path / "a", tmp_path / "b"):
        commit(stored.select(F.lit(ts(0)).alias("system_time"), "*"), str(base / "d"), str(base / "l"), system_time=ts(0), commit_id="before")
    batches = [made(4, rng) for _ in range(4)]
    for i, data in enumerate(batches):
        spark.createDataFrame(data, KIND).coalesce(1).write.mode("append").parquet(str(raw))
        if i == 1:
            run(spark, tmp_path / "a", raw)
            # The history's rows are not needed any more: what is read is the state.
            shutil.rmtree(tmp_path / "a" / "d" / "__commit=before")
        if i > 1:
            run(spark, tmp_path / "a", raw)
    run(spark, tmp_path / "a", raw)
    want = stored.select(F.lit(ts(0)).alias("system_time"), "*")
    for i, data in enumerate(batches):
        new = ledger_merge(want, spark.createDataFrame(data, KIND), key=KEY, system_time=ts(i))
        want = want.union(spark.createDataFrame(new.collect(), new.schema))
    got = read_history(spark, str(tmp_path / "a" / "d"), str(tmp_path / "a" / "l"))
    columns = ["k", "j", "at", "d", "big"]
    old = stored.select(*columns)
    assert rows(got.select(*columns)) == rows(want.select(*columns).exceptAll(old))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert read_log(spark, str(tmp_path / "a" / "l")).count() == 5


def test_duplicates_of_one_batch_stay_and_restarts_add_nothing(spark, tmp_path):
    raw = tmp_path / "raw"
    data = [(1, "x", None, None, n, None, None) for n in range(5)] + [(None, None, None, None, 9, None, None)] * 2
    spark.createDataFrame(data, KIND).coalesce(1).write.parquet(str(raw))
    run(spark, tmp_path, raw)
    spark.createDataFrame(data[:1] + [(2, "y", None, None, 1, None, None)], KIND).coalesce(1).write.mode("append").parquet(str(raw))
    run(spark, tmp_path, raw)
    run(spark, tmp_path, raw)
    got = read_history(spark, str(tmp_path / "d"), str(tmp_path / "l"))
    assert rows(got, "k", "big") == rows(spark.createDataFrame([(1, n) for n in range(5)] + [(None, 9)] * 2 + [(2, 1)], "k int, big bigint"))
    # As the merge of each batch does it.
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(str(raw))
    where = {"data_dir": str(tmp_path / "d2"), "log_dir": str(tmp_path / "l2"), "checkpoint": str(tmp_path / "c2")}
    poll(stream, merge=merge_strategy("ledger", key=KEY), system_time=ts, **where).awaitTermination()
    plain = read_history(spark, where["data_dir"], where["log_dir"])
    assert rows(plain, "k", "j", "big") == rows(got, "k", "j", "big")
