"""Histories over many commits: stored states, nested columns, backfills, bounds, digests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelog import (
    as_of,
    backfill_history,
    commit,
    fold_state,
    read_history,
    read_latest,
    snapshot_merge,
    table_digest,
    verify_history,
)
from workload.base import ORDERS, TIMES, at, query, sql_at, sql_changes, stored, table
from workload.sql import ORDER_JSON, exact_orders, sql_digest
from workload.workspace import shared_folder

_WHEN = [datetime.fromisoformat(t) for t in TIMES]

# Three dumps in which the priority of an order comes and goes, its price moves, and orders go and return.
_DUMPS = [
    "select * replace (nullif(o_orderpriority, '1-URGENT') as o_orderpriority) from orders where o_orderstatus <> 'O'",
    "select * replace (nullif(o_orderpriority, '2-HIGH') as o_orderpriority,"
    " case when o_orderpriority = '3-MEDIUM' then o_totalprice + 1 else o_totalprice end as o_totalprice)"
    " from orders where o_orderstatus <> 'F' or o_custkey % 3 > 0",
    "select * replace (case when o_orderpriority <> '5-LOW' then '0-NONE' end as o_orderpriority) from orders where o_custkey % 5 > 0",
    "select * from orders where o_orderstatus <> 'P' or o_custkey % 3 = 1",
]


def _dumps(spark, sf_dir) -> list[DataFrame]:
    orders = table(spark, sf_dir, "orders")
    p, price = F.col("o_orderpriority"), F.col("o_totalprice")
    return [
        orders.filter("o_orderstatus <> 'O'").withColumn("o_orderpriority", F.when(p != "1-URGENT", p)),
        orders.filter("o_orderstatus <> 'F' or o_custkey % 3 > 0")
        .withColumn("o_totalprice", F.when(p == "3-MEDIUM", price + 1).otherwise(price))
        .withColumn("o_orderpriority", F.when(p != "2-HIGH", p)),
        orders.filter("o_custkey % 5 > 0").withColumn("o_orderpriority", F.when(p != "5-LOW", "0-NONE")),
        orders.filter("o_orderstatus <> 'P' or o_custkey % 3 = 1"),
    ]


def _emitted(dumps: list[str], changed: str, last: str) -> str:
    """Each dump against the rows last emitted; ``last`` reads the log of all steps.

    ``s<i>`` are the emitted rows after step i: those of the dump that are new or changed, else as before.
    """
    steps = [f"s0 as (select * from ({dumps[0]}))"]
    for i, dump in enumerate(dumps[1:], 1):
        took = ", ".join(f"case when p.o_orderkey is null or {changed} then c.{v} else p.{v} end as {v}" for v in ORDERS)
        steps.append(f"s{i} as (select {took} from ({dump}) c left join s{i - 1} p on p.o_orderkey = c.o_orderkey)")
    rows = [f"select {sql_at(0)} as system_time, {sql_at(0)} as event_time, 'I' as observed, * from s0"]
    rows += [sql_changes(f"select * from s{i - 1}", dump, ["o_orderkey"], ORDERS, i, changed=f"coalesce({changed}, false)") for i, dump in enumerate(dumps[1:], 1)]
    return f"with {', '.join(steps)}, log as ({' union all '.join(rows)}) {last}"


_DEFAULT = " or ".join(f"p.{v} <> c.{v}" for v in ORDERS[1:])


@query(_emitted(_DUMPS, _DEFAULT, "select * from log"))
def snapshot_stored_state(spark, sf_dir):
    """Four dumps; each is merged into the stored state and the commits after it."""
    base = shared_folder(spark, "state")
    where = {"data_dir": f"{base}/data", "log_dir": f"{base}/log"}
    for step, dump in enumerate(_dumps(spark, sf_dir)):
        prev = read_latest(spark, **where, state_dir=f"{base}/state", key=["o_orderkey"])
        rows = snapshot_merge(prev, dump, key=["o_orderkey"], system_time=at(step))
        commit(rows, **where, system_time=_WHEN[step], commit_id=f"step-{step}")
        if step != 1:
            fold_state(spark, **where, state_dir=f"{base}/state", key=["o_orderkey"])
    return read_history(spark, **where)


_ORDERED = "select * exclude (rn) from (select *, row_number() over (partition by o_orderkey order by event_time desc) as rn from log) where rn = 1 and observed <> 'D'"


@query(_emitted(_DUMPS[:3], _DEFAULT, _ORDERED))
def stored_state_as_of(spark, sf_dir):
    """The latest rows from the stored state of two commits and the third."""
    base = shared_folder(spark, "latest")
    where = {"data_dir": f"{base}/data", "log_dir": f"{base}/log"}
    for step, dump in enumerate(_dumps(spark, sf_dir)[:3]):
        prev = read_latest(spark, **where, state_dir=f"{base}/state", key=["o_orderkey"])
        commit(snapshot_merge(prev, dump, key=["o_orderkey"], system_time=at(step)), **where, system_time=_WHEN[step], commit_id=f"step-{step}")
        if step == 1:
            fold_state(spark, **where, state_dir=f"{base}/state", key=["o_orderkey"])
    return as_of(read_latest(spark, **where, state_dir=f"{base}/state", key=["o_orderkey"]), ["o_orderkey"])


def _all_dumps(spark, sf_dir) -> DataFrame:
    out = None
    for step, dump in enumerate(_dumps(spark, sf_dir)):
        dump = dump.withColumn("snapshot_time", at(step))
        out = dump if out is None else out.union(dump)
    return out


_AT_ONCE = f"select {sql_at(3)} as system_time, * exclude (system_time) from log"


@query(_emitted(_DUMPS, _DEFAULT, _AT_ONCE))
def backfill_default_mode(spark, sf_dir):
    """The same dumps in one pass; priorities that come and go are no changes, yet what was emitted counts."""
    return backfill_history(_all_dumps(spark, sf_dir), key=["o_orderkey"], times=_WHEN, system_time=at(3), null_safe=False)


@query(_emitted(_DUMPS, "p.o_totalprice is distinct from c.o_totalprice", _AT_ONCE))
def backfill_compare_columns(spark, sf_dir):
    return backfill_history(_all_dumps(spark, sf_dir), key=["o_orderkey"], times=_WHEN, system_time=at(3), compare=["o_totalprice"])


_LINE_KEY = "l_orderkey, l_linenumber"
_LINE_VALUES = "l_partkey, l_quantity, l_returnflag"
_LINE = f"{_LINE_KEY}, {_LINE_VALUES}"
_LINES_0 = f"select {_LINE} from lineitem where l_linestatus = 'F'"
_LINES_1 = f"select * replace (case when l_returnflag = 'R' then 'X' else l_returnflag end as l_returnflag) from (select {_LINE} from lineitem)"
_FIRST = f"qualify row_number() over (partition by {_LINE_KEY} order by {_LINE_VALUES}) = 1"


@query(
    f"with p as (select * from ({_LINES_0}) {_FIRST}),"
    f" c as (select c.*, p.l_orderkey is not null as known from ({_LINES_1}) c left join p using (l_orderkey, l_linenumber)"
    " where p.l_orderkey is null or p.l_partkey <> c.l_partkey or p.l_quantity <> c.l_quantity or p.l_returnflag <> c.l_returnflag)"
    f" select {sql_at(1)} as system_time, {sql_at(0)} as event_time, 'I' as observed, * from p"
    f" union all select {sql_at(1)}, {sql_at(1)}, case when known then 'U' else 'I' end, * exclude (known) from (select * from c {_FIRST})"
)
def backfill_duplicates(spark, sf_dir):
    """Dumps whose key is not unique, some keys as arrays and some dump by dump."""
    spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    lines = table(spark, sf_dir, "lineitem").select(*_LINE.split(", "), "l_linestatus")
    flag = F.col("l_returnflag")
    first = lines.filter("l_linestatus = 'F'").withColumn("snapshot_time", at(0))
    second = lines.withColumn("l_returnflag", F.when(flag == "R", "X").otherwise(flag)).withColumn("snapshot_time", at(1))
    dumps = first.union(second).drop("l_linestatus")
    return backfill_history(
        dumps, key=["l_orderkey", "l_linenumber"], times=_WHEN[:2], system_time=at(1), null_safe=False, unique=False, fold_rows=5
    )


@query(
    f"select {sql_at(1)} as system_time, 'U' as observed, event_id, cast(json_extract_string(props, '$.k') as integer)"
    " + case when event_id % 5 = 0 then 1 else 0 end as k, case when event_id % 7 = 0 then event_type end as kind,"
    " case when event_id % 3 = 0 then user_id end as inside from events where event_id % 5 = 0 or event_id % 7 = 0 or event_id % 3 = 0"
)
def snapshot_nested_fields(spark, sf_dir):
    """A struct from the events' properties that gains fields at two depths; narrower numbers are widened."""
    events = table(spark, sf_dir, "events")
    k = F.from_json("props", "k int")["k"]
    history = stored(events.select("event_id", F.struct(k.alias("k"), F.array(F.struct(k.alias("x"))).alias("l")).alias("p")))
    moved = (k + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)).cast("short")
    item = F.struct(F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("y"), k.cast("short").alias("x"))
    now = F.struct(F.when(F.col("event_id") % 7 == 0, F.col("event_type")).alias("kind"), moved.alias("k"), F.array(item).alias("l"))
    out = snapshot_merge(history, events.select("event_id", now.alias("p")), key=["event_id"], system_time=at(1))
    return out.select("system_time", "observed", "event_id", "p.k", "p.kind", F.col("p.l")[0]["y"].alias("inside"))


_STATUSES = ["F", "O", "P"]


def _committed_by_status(spark, sf_dir, purpose: str) -> dict[str, str]:
    base = shared_folder(spark, purpose)
    where = {"data_dir": f"{base}/data", "log_dir": f"{base}/log"}
    orders = exact_orders(spark, sf_dir)
    for i, status in enumerate(_STATUSES):
        commit(orders.filter(F.col("o_orderstatus") == status), **where, system_time=_WHEN[i], commit_id=status)
    return where


@query(sql_digest(ORDER_JSON, "select * from orders"))
def digest_from_log(spark, sf_dir):
    """The digest of a table of three commits as the sum of theirs."""
    return table_digest(spark, _committed_by_status(spark, sf_dir, "sums")["log_dir"])


@query(
    "select 'O' as commit_id, 'altered' as problem, n as recorded, n as stored from (select count(*) as n from orders where o_orderstatus = 'O')"
    " union all select 'P', 'lost', count(*), cast(0 as bigint) from orders where o_orderstatus = 'P'"
    " union all select 'stray', 'foreign', null, count(*) from orders where o_orderstatus = 'F' and o_custkey % 2 = 0"
)
def verify_commits(spark, sf_dir):
    """One commit has a changed price, one lost its rows, and one directory has no record."""
    where = _committed_by_status(spark, sf_dir, "verify")
    orders, least = exact_orders(spark, sf_dir), F.col("o_totalprice")
    open_ = orders.filter("o_orderstatus = 'O'")
    key = open_.agg(F.min("o_orderkey")).first()[0]
    moved = open_.withColumn("o_totalprice", F.when(F.col("o_orderkey") == key, least + 1).otherwise(least).cast("decimal(18,2)"))
    moved.write.mode("overwrite").parquet(f"{where['data_dir']}/__commit=O")
    orders.limit(0).write.mode("overwrite").parquet(f"{where['data_dir']}/__commit=P")
    orders.filter("o_orderstatus = 'F' and o_custkey % 2 = 0").write.parquet(f"{where['data_dir']}/__commit=stray")
    return verify_history(spark, **where)


_SINCE, _UNTIL = datetime(2024, 1, 8), datetime(2024, 1, 19, 12)


@query(f"select * from events where ts >= timestamp '{_SINCE}' and ts <= timestamp '{_UNTIL}'")
def history_within_bounds(spark, sf_dir):
    """Events committed week by week, read back between two times; other weeks are not listed."""
    base = shared_folder(spark, "weeks")
    where = {"data_dir": f"{base}/data", "log_dir": f"{base}/log"}
    events = table(spark, sf_dir, "events")
    start, last = events.agg(F.min("ts"), F.max("ts")).first()
    day, week = datetime(start.year, start.month, start.day), 0
    while day <= last:
        part = events.filter((F.col("ts") >= F.lit(str(day)).cast("timestamp_ntz")) & (F.col("ts") < F.lit(str(day + timedelta(7))).cast("timestamp_ntz")))
        commit(part, **where, system_time=day, commit_id=f"week-{week}", event_time_column="ts")
        day, week = day + timedelta(7), week + 1
    return read_history(spark, **where, since=_SINCE, until=_UNTIL, event_time_column="ts")
