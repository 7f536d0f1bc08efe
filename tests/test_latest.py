"""As-of projection and deduplication."""

import pytest
from pyspark.sql import functions as F

from tablelog import as_of, one_per_key
from tests.conftest import ordered, rows, ts

KIND = "system_time timestamp, event_time timestamp, observed string, {} int, name string, data string"
# A shelf of parts: 11 is relabelled twice, 12 goes and comes back, 13 never changes, 14 goes for good.
SERIES = [
    (1, "I", 11, "bolt", "m3"),
    (1, "I", 12, "nut", "m3"),
    (2, "I", 13, "washer", "m5"),
    (2, "U", 11, "bolt", "m4"),
    (3, "D", 12, "nut", "m3"),
    (4, "I", 14, "spring", "s"),
    (5, "U", 11, "bolt", "m6"),
    (6, "I", 12, "nut", "m8"),
    (7, "D", 14, "spring", "s"),
]
COMPOUND = [
    (1, "I", 7, "left", "10"),
    (1, "I", 7, "right", "20"),
    (2, "U", 7, "right", "21"),
    (3, "I", 8, "left", "30"),
    (4, "D", 7, "left", "10"),
    (5, "U", 8, "left", "33"),
]


def series(spark, data, key="id"):
    return spark.createDataFrame([(ts(0), ts(t), *r) for t, *r in data], KIND.format(key))


def expect(*data):
    return ordered([(ts(0), ts(t), *r) for t, *r in data])


def test_latest(spark):
    out = as_of(series(spark, SERIES), ["id"])
    assert out.columns == ["system_time", "event_time", "observed", "id", "name", "data"]
    assert rows(out) == expect(
        (5, "U", 11, "bolt", "m6"), (6, "I", 12, "nut", "m8"), (2, "I", 13, "washer", "m5")
    )


def test_at_time(spark):
    out = as_of(series(spark, SERIES), ["id"], at=ts(4))
    assert rows(out) == expect(
        (2, "U", 11, "bolt", "m4"), (2, "I", 13, "washer", "m5"), (4, "I", 14, "spring", "s")
    )


def test_compound_key(spark):
    out = as_of(series(spark, COMPOUND, "key"), ["key", "name"])
    assert rows(out) == expect((2, "U", 7, "right", "21"), (5, "U", 8, "left", "33"))


def test_nulls(spark):
    df = spark.createDataFrame(
        [
            (None, "I", 1, "early"),
            (ts(1), "I", 1, None),
            (None, "I", 2, "only"),
            (ts(1), None, 3, "unknown"),
            (ts(0), "I", None, "p"),
            (ts(1), "U", None, "q"),
        ],
        "event_time timestamp, observed string, id int, v string",
    )
    out = as_of(df, ["id"])
    assert rows(out, "id", "v") == ordered([(1, None), (2, "only"), (None, "q")])


def test_ties_are_deterministic(spark):
    df = spark.range(1000).select(
        F.lit(ts(0)).alias("event_time"),
        F.lit("U").alias("observed"),
        (F.col("id") % 3).alias("id"),
        F.col("id").alias("seq"),
        (-F.col("id")).alias("v"),
    )
    for n in (1, 7):
        out = as_of(df.repartition(n), ["id"], ties=["v"])
        assert rows(out, "id", "v") == [(0, 0), (1, -1), (2, -2)]
        out = as_of(df.repartition(n), ["id"])
        assert rows(out, "id", "v") == [(0, -999), (1, -997), (2, -998)]


def test_maps(spark):
    df = spark.createDataFrame(
        [(ts(0), "I", 1, {"a": 1}), (ts(1), "U", 1, {"a": 2})],
        "event_time timestamp, observed string, id int, m map<string,int>",
    )
    assert as_of(df, ["id"]).first()["m"] == {"a": 2}


def test_plan(spark, tmp_path):
    path = str(tmp_path / "s")
    series(spark, SERIES).write.parquet(path)
    text = as_of(spark.read.parquet(path), ["id"], at=ts(1))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text
    assert "LessThanOrEqual(event_time" in text
    assert "partial_max" in text


@pytest.mark.parametrize("parts", [1, 5])
def test_one_per_key(spark, parts):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 3), (2, None, 5), (2, "x", 1), (None, "n", 1), (None, "n", 1)],
        "k int, s string, n int",
    ).repartition(parts)
    assert rows(one_per_key(df, ["k"])) == ordered([(1, "a", 3), (2, None, 5), (None, "n", 1)])
    assert rows(one_per_key(df, ["k"], ["n"])) == ordered([(1, "b", 2), (2, "x", 1), (None, "n", 1)])
    assert rows(one_per_key(df.select("k"), ["k"])) == ordered([(1,), (2,), (None,)])
