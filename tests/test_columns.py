"""Times, column lookup and reconciliation."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog import append_merge, as_of, reconcile
from tablelog.functions.columns import has_column, time_literal
from tests.conftest import rows, ts


def test_time_literal_in_any_zone(spark):
    moment = dt.datetime(2024, 11, 3, 5, 30, 0, 8)
    aware = moment.replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=9)))
    epoch = int(moment.replace(tzinfo=dt.timezone.utc).timestamp()) * 10**6 + 8
    # In New York this hour comes twice.
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            row = spark.range(1).select(
                *[F.unix_micros(time_literal(m, T.TimestampType())) for m in (moment, aware)],
                *[time_literal(m, T.TimestampNTZType()).cast("string") for m in (moment, aware)],
            ).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(row) == (epoch, epoch, *["2024-11-03 05:30:00.000008"] * 2)


def test_zoneless_history_filter_is_pushed(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.sql(
        "select timestamp_ntz'2020-01-01 00:00:00' event_time, 'I' observed, 1 id"
    ).write.parquet(path)
    out = as_of(spark.read.parquet(path), ["id"], at=ts(0))
    assert out.count() == 1
    assert "LessThanOrEqual(event_time" in out._jdf.queryExecution().executedPlan().toString()


def test_names_follow_the_session(spark):
    df = spark.createDataFrame([(1, 2)], "Id int, v int")
    assert has_column(df, "ID")
    prev = spark.createDataFrame([(ts(0), 5, 6)], "system_time timestamp, id int, v int")
    assert append_merge(prev, df, system_time=ts(1)).columns == ["system_time", "id", "v"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert not has_column(df, "ID")
        out = append_merge(prev, df, system_time=ts(1))
        assert out.columns == ["system_time", "id", "v", "Id"]
        assert rows(out, "id", "Id") == [(None, 1)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_reconcile(spark):
    prev = spark.createDataFrame([(1, "a", 2)], "k int, gone string, v bigint")
    curr = spark.createDataFrame([(3.5, 4, 5)], "fresh double, v int, k int")
    both = reconcile(prev, curr)
    assert both.added == {"fresh"} and both.removed == {"gone"}
    assert both.prev.columns == both.curr.columns == ["k", "gone", "v", "fresh"]
    assert both.prev.dtypes == both.curr.dtypes
    assert rows(both.prev) == [(1, "a", 2, None)] and rows(both.curr) == [(5, None, 4, 3.5)]
    alone = reconcile(None, curr)
    assert alone.curr is curr and alone.prev.count() == 0 and not alone.added | alone.removed
    # A column that was never anything but NULL takes the type it is first given.
    void = prev.withColumn("fresh", F.lit(None))
    assert reconcile(void, curr).prev.schema["fresh"].dataType == T.DoubleType()
