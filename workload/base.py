"""Registry and the dumps that the merge queries work on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# System and event times of successive commits.
TIMES = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]


def query(oracle: str | None = None):
    """Register a query under its function name, with its SQL counterpart."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(step: int) -> Column:
    return F.lit(TIMES[step]).cast("timestamp_ntz")


def sql_at(step: int) -> str:
    return f"timestamp '{TIMES[step]}'"


ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def earlier_orders(orders: DataFrame) -> DataFrame:
    """First dump: the newest open orders are not placed yet."""
    return orders.filter(~((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= "2000-01-01")))


def later_orders(orders: DataFrame) -> DataFrame:
    """Second dump: closed orders of low priority are purged, pending ones repriced."""
    repriced = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1)
    return orders.filter(
        ~((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"))
    ).withColumn("o_totalprice", repriced.otherwise(F.col("o_totalprice")))


EARLIER = "select * from orders where not (o_orderstatus = 'O' and o_orderdate >= timestamp '2000-01-01')"
LATER = (
    "select o_orderkey, o_custkey, o_orderstatus,"
    " case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end as o_totalprice,"
    " o_orderdate, o_orderpriority"
    " from orders where not (o_orderstatus = 'F' and o_orderpriority = '5-LOW')"
)


def stored(dump: DataFrame, step: int = 0, snapshot: bool = True) -> DataFrame:
    """The history a first dump with unique keys leaves behind."""
    marks = [at(step).alias("system_time")]
    if snapshot:
        marks += [at(step).alias("event_time"), F.lit("I").alias("observed")]
    return dump.select(*marks, *dump.columns)


def sql_changes(
    prev: str,
    curr: str,
    key: Sequence[str],
    columns: Sequence[str],
    step: int,
    changed: str | None = None,
    null_safe: bool = False,
) -> str:
    """The difference of two dumps with unique keys, as a full join.

    ``columns`` are those both sides have; ``changed`` replaces the column comparison.
    """
    values = [c for c in columns if c not in key]
    unequal = "is distinct from" if null_safe else "<>"
    on = " and ".join(f"c.{k} is not distinct from p.{k}" for k in key)
    test = changed or " or ".join(f"p.{v} {unequal} c.{v}" for v in values)
    chosen = ", ".join(f"case when c.here then c.{v} else p.{v} end as {v}" for v in columns)
    return (
        f"select {sql_at(step)} as system_time, {sql_at(step)} as event_time,"
        " case when c.here is null then 'D' when p.here is null then 'I' else 'U' end as observed,"
        f" {chosen}"
        f" from (select *, true as here from ({curr})) c"
        f" full join (select *, true as here from ({prev})) p on {on}"
        f" where c.here is null or p.here is null or ({test})"
    )
