"""Column clean-up and the user's own SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelog import SqlFunction, dataset_digest, normalise_columns, preprocess, to_back, to_front
from workload.base import query, table
from workload.workspace import shared_folder

# What a messy file might call the columns of part, and what they become.
_MESSY = ["p partkey", "p(name)", "p,brand", "p{type};", "p\tsize", "p=retail\nprice"]


@query(
    "select p_partkey, p_name as p_name_, p_brand, p_type as p_type__, p_size as psize,"
    " p_retailprice as p_retailprice from part"
)
def normalised_names(spark, sf_dir):
    return normalise_columns(table(spark, sf_dir, "part").toDF(*_MESSY))


@query("select p_size, p_partkey, p_brand, p_type, p_retailprice, p_name from part")
def column_order(spark, sf_dir):
    return to_back(to_front(table(spark, sf_dir, "part"), "p_size"), "p_name")


@query(
    "with late as (select o_custkey, o_totalprice from orders where o_orderstatus <> 'F')"
    " select o_custkey, count(*) as n, max(o_totalprice) as top from late group by o_custkey"
)
def preprocess_steps(spark, sf_dir):
    return preprocess(
        table(spark, sf_dir, "orders"),
        [
            ("select o_custkey, o_totalprice from input where o_orderstatus <> 'F'", "late"),
            ("select o_custkey, count(*) as n, max(o_totalprice) as top from late group by o_custkey", "output"),
            ("select * from input", None),
        ],
    )


_WINDOW = (
    "select event_id, user_id, row_number() over w as rn, lag(event_type) over w as before,"
    " max(value) over (partition by user_id order by ts, event_id"
    " rows between 2 preceding and current row) as top3"
    " from {} window w as (partition by user_id order by ts, event_id)"
)


@query(_WINDOW.format("events"))
def preprocess_window(spark, sf_dir):
    return preprocess(table(spark, sf_dir, "events"), [(_WINDOW.format("input"), None)])


_ROLLUP = (
    "select o_orderstatus, o_orderpriority, count(*) as n, max(o_totalprice) as top,"
    " cast(grouping(o_orderstatus) + grouping(o_orderpriority) as int) as level"
    " from {} group by rollup (o_orderstatus, o_orderpriority)"
)


@query(_ROLLUP.format("orders"))
def preprocess_rollup(spark, sf_dir):
    return preprocess(table(spark, sf_dir, "orders"), [(_ROLLUP.format("input"), None)])


_SETOPS = (
    "select user_id from {0} where event_type = 'purchase'"
    " intersect select user_id from {0} where event_type = 'signup'"
    " except select user_id from {0} where event_type = 'error' and value > 60"
    " union select user_id from {0} where value < 1"
)


@query(_SETOPS.format("events"))
def preprocess_setops(spark, sf_dir):
    return preprocess(table(spark, sf_dir, "events"), [(_SETOPS.format("input"), None)])


@query(
    "select user_id, count(*) as n, sum(cast(json_extract_string(props, '$.k') as int)) as total"
    " from events group by user_id"
)
def preprocess_json(spark, sf_dir):
    steps = [
        ("select user_id, from_json(props, 'k int').k as k from input", "parsed"),
        ("select user_id, count(*) as n, sum(k) as total from parsed group by user_id", None),
    ]
    return preprocess(table(spark, sf_dir, "events"), steps)


_BAND = SqlFunction("price_band", "price DOUBLE, width DOUBLE", "BIGINT", "cast(floor(price / width) as bigint)")
_RECENT = SqlFunction(
    "orders_since",
    "day STRING",
    "TABLE (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE)",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM stored_orders WHERE o_orderdate >= cast(day as timestamp_ntz)",
)


@query(
    "select cast(floor(o_totalprice / 50000) as bigint) as band, count(*) as n, count(distinct o_custkey) as customers"
    " from orders where o_orderdate >= timestamp '1999-06-01' group by 1"
)
def preprocess_functions(spark, sf_dir):
    """Steps with a scalar and a table function declared in SQL, in a session of their own."""
    own = spark.newSession()
    table(own, sf_dir, "orders").createOrReplaceTempView("stored_orders")
    for function in (_BAND, _RECENT):
        function.declare(own)
    steps = [
        ("select price_band(o_totalprice, 50000) as band, o_custkey from orders_since('1999-06-01')", "banded"),
        ("select band, count(*) as n, count(distinct o_custkey) as customers from banded group by band", None),
    ]
    return preprocess(table(own, sf_dir, "orders"), steps)


@query(
    "with c as (select o_custkey, count(*) as n, max(o_totalprice) as top from orders group by o_custkey)"
    " select c.o_custkey, c.n, c.top from c, (select avg(n) as mean from c) where c.n > mean"
)
def preprocess_shared_step(spark, sf_dir):
    """A step that two later ones read; it is kept and computed once, and released when the result is written."""
    steps = [
        ("select o_custkey, count(*) as n, max(o_totalprice) as top from input group by o_custkey", "customers"),
        ("select avg(n) as mean from customers", "mean"),
        ("select c.* from customers c cross join mean m where c.n > m.mean", None),
    ]
    kept = []
    path = shared_folder(spark, "shared-step")
    preprocess(table(spark, sf_dir, "orders"), steps, shared=kept).write.parquet(path)
    for frame in kept:
        frame.unpersist()
    return spark.read.parquet(path)


def sql_digest(json: str, rows: str) -> str:
    """Count and digest of ``rows``, given each row's JSON text as an expression."""
    lanes = [
        f"sum(cast(cast('0x' || substr(h, {1 + 15 * i}, 15) as ubigint) as hugeint)) as l{i}"
        for i in range(2)
    ]
    return (
        "select sha256(concat_ws(':', n, coalesce(l0, 0), coalesce(l1, 0)))"
        f" as hash, n as num_records from (select count(*) as n, {', '.join(lanes)}"
        f" from (select sha256({json}) as h from ({rows})))"
    )


ORDER_JSON = (
    """'{"o_custkey":' || o_custkey || ',"o_orderdate":"' || cast(o_orderdate as varchar)"""
    """ || '","o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority"""
    """ || '","o_orderstatus":"' || o_orderstatus || '","o_totalprice":'"""
    """ || cast(cast(o_totalprice as decimal(18,2)) as varchar) || '}'"""
)


def exact_orders(spark, sf_dir):
    """Orders with the price as decimal: engines print doubles differently."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "orders").withColumn("o_totalprice", price)


@query(sql_digest(ORDER_JSON, "select * from orders"))
def orders_digest(spark, sf_dir):
    return dataset_digest(exact_orders(spark, sf_dir))
