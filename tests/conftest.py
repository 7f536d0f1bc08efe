import datetime as dt

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tablelog-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def large(spark):
    """Plans as for large tables: Spark would broadcast the small ones of a test."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def final_plan(df):
    """The physical plan after running it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def salted_exchanges(plan):
    return sum("__salt" in e[:100] for e in plan.split("Exchange hash")[1:])


def ts(n: int) -> dt.datetime:
    """The n-th instant of a test, in order."""
    return dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=n)


def plain(value):
    """Collected timestamps are naive session-zone values; the test session is UTC."""
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def rows(df, *columns):
    """Collected rows as sorted tuples."""
    got = (df.select(*columns) if columns else df).collect()
    return ordered([tuple(r) for r in got])


def ordered(tuples):
    tuples = [tuple(plain(v) for v in t) for t in tuples]
    return sorted(tuples, key=lambda t: [(v is not None, str(type(v)), v if v is not None else 0) for v in t])
