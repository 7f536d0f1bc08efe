"""Append, ledger and snapshot merges, and the backfill."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tablelog import (
    append_merge,
    backfill_history,
    commit,
    event_time_bounds,
    ledger_merge,
    merge_strategy,
    one_per_key,
    read_history,
    snapshot_merge,
)
from workload.base import (
    EARLIER,
    LATER,
    ORDERS,
    TIMES,
    at,
    earlier_orders,
    later_orders,
    query,
    sql_at,
    sql_changes,
    stored,
    table,
)
from workload.workspace import shared_folder

_ALL = ", ".join(ORDERS)
_FRESH = (
    f"select {sql_at(1)} as system_time, {{columns}} from ({LATER}) c where not exists"
    f" (select 1 from ({EARLIER}) p where p.o_orderkey is not distinct from c.o_orderkey)"
)


def _dumps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return earlier_orders(orders), later_orders(orders)


@query(f"select {sql_at(1)} as system_time, {_ALL} from ({LATER})")
def append_merge_rows(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    return append_merge(stored(first, snapshot=False), second, system_time=at(1))


@query(f"select {sql_at(1)} as system_time, {_ALL} from ({LATER})")
def append_added_column(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    history = stored(first.drop("o_orderpriority"), snapshot=False)
    return append_merge(history, second, system_time=at(1))


@query(
    f"select {sql_at(1)} as system_time, o_orderkey, o_custkey, o_orderstatus, o_totalprice,"
    f" o_orderdate, cast(null as varchar) as o_orderpriority from ({LATER})"
)
def append_removed_column(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    return append_merge(
        stored(first, snapshot=False), second.drop("o_orderpriority"), system_time=at(1)
    )


@query(_FRESH.format(columns=_ALL))
def ledger_merge_rows(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    return ledger_merge(
        stored(first, snapshot=False), second, key=["o_orderkey"], system_time=at(1)
    )


_NULLED = "select case when o_orderstatus = '{}' then null else o_custkey end as k, * from ({})"
_UNSEEN = (
    f"select {sql_at(1)} as system_time, c.* from ({_NULLED.format('P', LATER)}) c where not exists"
    f" (select 1 from ({_NULLED.format('F', EARLIER)}) p where p.k is not distinct from c.k)"
)


def _nulled(spark, sf_dir, **options):
    """A third of either side has no key; a NULL key counts as seen once stored."""
    first, second = _dumps(spark, sf_dir)

    def nulled(df, status):
        k = F.when(F.col("o_orderstatus") != status, F.col("o_custkey"))
        return df.select(k.alias("k"), "*")

    # Customers with an even number are new to the history.
    history = stored(nulled(first.filter("o_custkey % 2 = 1 or o_orderstatus = 'F'"), "F"), snapshot=False)
    return ledger_merge(history, nulled(second, "P"), key=["k"], system_time=at(1), **options)


_UNSEEN = _UNSEEN.replace("where p.k is not", "where (p.o_custkey % 2 = 1 or p.o_orderstatus = 'F') and p.k is not")


@query(_UNSEEN)
def ledger_null_key(spark, sf_dir):
    return _nulled(spark, sf_dir)


@query(_UNSEEN)
def ledger_large_batch(spark, sf_dir):
    """The plan for batches too large to broadcast, on a key that a third of the rows share."""
    return _nulled(spark, sf_dir, broadcast_bytes=0)


@query(
    f"select {sql_at(1)} as system_time, c.* from lineitem c where not exists"
    " (select 1 from lineitem p where p.l_shipdate < timestamp '1999-01-01'"
    " and p.l_orderkey = c.l_orderkey and p.l_linenumber = c.l_linenumber)"
)
def ledger_compound_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    history = stored(lines.filter(F.col("l_shipdate") < "1999-01-01"), snapshot=False)
    return ledger_merge(history, lines, key=["l_orderkey", "l_linenumber"], system_time=at(1))


@query(_FRESH.format(columns=_ALL))
def ledger_added_column(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    history = stored(first.drop("o_orderpriority"), snapshot=False)
    return ledger_merge(history, second, key=["o_orderkey"], system_time=at(1))


@query(
    _FRESH.format(
        columns="o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,"
        " cast(null as varchar) as o_orderpriority"
    )
)
def ledger_removed_column(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    return ledger_merge(
        stored(first, snapshot=False),
        second.drop("o_orderpriority"),
        key=["o_orderkey"],
        system_time=at(1),
    )


@query(
    f"select {sql_at(0)} as system_time, {sql_at(0)} as event_time, 'I' as observed, * from customer"
)
def snapshot_initial(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return snapshot_merge(None, customers, key=["c_custkey"], system_time=at(0))


def _diff(spark, sf_dir, **options):
    first, second = _dumps(spark, sf_dir)
    return snapshot_merge(
        stored(first), second, key=["o_orderkey"], system_time=at(1), **options
    )


@query(sql_changes(EARLIER, LATER, ["o_orderkey"], ORDERS, 1))
def snapshot_changes(spark, sf_dir):
    return _diff(spark, sf_dir)


_SKEWED = "select case when o_orderstatus = 'O' then null else o_custkey end as k, o_orderkey, o_totalprice from ({})"


@query(
    f"with p as (select k, min(o_orderkey) as o_orderkey, arg_min(o_totalprice, o_orderkey) as o_totalprice from ({_SKEWED.format(EARLIER)}) group by k),"
    f" a as ({_SKEWED.format(LATER)}),"
    " c as (select a.k, p.o_orderkey is not null as known, a.o_orderkey, a.o_totalprice from a left join p on a.k is not distinct from p.k"
    " where p.o_orderkey is null or a.o_orderkey <> p.o_orderkey or a.o_totalprice <> p.o_totalprice)"
    f" select {sql_at(1)} as system_time, {sql_at(1)} as event_time, case when bool_or(known) then 'U' else 'I' end as observed,"
    " k, min(o_orderkey) as o_orderkey, arg_min(o_totalprice, o_orderkey) as o_totalprice from c group by k"
    f" union all select {sql_at(1)}, {sql_at(1)}, 'D', k, o_orderkey, o_totalprice from p"
    " where not exists (select 1 from a where a.k is not distinct from p.k)"
)
def snapshot_split_keys(spark, sf_dir):
    """Dumps with a key that a third of the rows share, which is split from 100 rows on."""

    def skewed(df):
        k = F.when(F.col("o_orderstatus") != "O", F.col("o_custkey"))
        return df.select(k.alias("k"), "o_orderkey", "o_totalprice")

    first, second = map(skewed, _dumps(spark, sf_dir))
    history = snapshot_merge(None, first, key=["k"], system_time=at(0))
    return snapshot_merge(history, second, key=["k"], system_time=at(1), hot_rows=100)


@query(
    sql_changes(
        EARLIER,
        LATER,
        ["o_orderkey"],
        ORDERS,
        1,
        changed="p.o_custkey <> c.o_custkey or p.o_orderstatus <> c.o_orderstatus",
    )
)
def snapshot_compare_columns(spark, sf_dir):
    return _diff(spark, sf_dir, compare=["o_custkey", "o_orderstatus"])


@query(
    sql_changes(
        f"select * exclude (o_orderpriority), cast(null as varchar) as o_orderpriority from ({EARLIER})",
        LATER,
        ["o_orderkey"],
        ORDERS,
        1,
        changed="p.o_totalprice <> c.o_totalprice or c.o_orderpriority is not null",
    )
)
def snapshot_added_column(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    history = stored(first.drop("o_orderpriority"))
    return snapshot_merge(history, second, key=["o_orderkey"], system_time=at(1))


@query(
    sql_changes(
        EARLIER,
        f"select * exclude (o_orderpriority), cast(null as varchar) as o_orderpriority from ({LATER})",
        ["o_orderkey"],
        ORDERS,
        1,
        changed="p.o_totalprice <> c.o_totalprice or p.o_orderpriority is not null",
    )
)
def snapshot_removed_column(spark, sf_dir):
    first, second = _dumps(spark, sf_dir)
    return snapshot_merge(
        stored(first), second.drop("o_orderpriority"), key=["o_orderkey"], system_time=at(1)
    )


_HOLES = "select * exclude (o_orderpriority), nullif(o_orderpriority, '{}') as o_orderpriority from ({})"
_NULL_SIDES = (_HOLES.format("4-NOT SPECIFIED", EARLIER), _HOLES.format("1-URGENT", LATER))


def _holes(spark, sf_dir, **options):
    def holes(df, value):
        p = F.col("o_orderpriority")
        return df.withColumn("o_orderpriority", F.when(p != value, p))

    first, second = _dumps(spark, sf_dir)
    return snapshot_merge(
        stored(holes(first, "4-NOT SPECIFIED")),
        holes(second, "1-URGENT"),
        key=["o_orderkey"],
        system_time=at(1),
        **options,
    )


@query(sql_changes(*_NULL_SIDES, ["o_orderkey"], ORDERS, 1))
def snapshot_null_change(spark, sf_dir):
    """By default going to or from NULL is no change."""
    return _holes(spark, sf_dir)


@query(sql_changes(*_NULL_SIDES, ["o_orderkey"], ORDERS, 1, null_safe=True))
def snapshot_null_safe(spark, sf_dir):
    return _holes(spark, sf_dir, null_safe=True)


_LINES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_VALUES = [c for c in _LINES if c not in _LINE_KEY]
_LEAST = (
    f"select {', '.join(_LINES)}{{extra}} from (select *, row_number() over (partition by"
    f" l_orderkey, l_linenumber order by {', '.join(_LINE_VALUES)}) as rn from ({{rows}})) where rn = 1"
)
_RELABELLED = "select * replace (case when l_returnflag = 'R' then 'X' else l_returnflag end as l_returnflag) from lineitem"
_LINE_OLD = _LEAST.format(extra="", rows="select * from lineitem where l_linestatus = 'F'")


@query(_LEAST.format(extra="", rows="select * from lineitem"))
def least_row_per_key(spark, sf_dir):
    return one_per_key(table(spark, sf_dir, "lineitem"), _LINE_KEY)


@query(
    f"with p as ({_LINE_OLD}), "
    "c as (select c.*, p.l_orderkey is not null as known from "
    f"({_RELABELLED}) c left join p using (l_orderkey, l_linenumber) where p.l_orderkey is null or "
    + " or ".join(f"p.{v} <> c.{v}" for v in _LINE_VALUES)
    + f") select {sql_at(1)} as system_time, {sql_at(1)} as event_time,"
    " case when known then 'U' else 'I' end as observed, * exclude (known) from ("
    + _LEAST.format(extra=", known", rows="select * from c")
    + ")"
)
def snapshot_duplicates(spark, sf_dir):
    """Dumps whose key is not unique; the least row that differs is taken."""
    lines = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    first = lines.filter(F.col("l_linestatus") == "F")
    second = lines.withColumn("l_returnflag", F.when(flag == "R", "X").otherwise(flag))
    history = snapshot_merge(None, first, key=_LINE_KEY, system_time=at(0))
    return snapshot_merge(history, second, key=_LINE_KEY, system_time=at(1))


_NOT_OPEN = "select * from orders where o_orderstatus <> 'O'"
_NOT_CLOSED = "select * from orders where o_orderstatus <> 'F'"
_REPRICED = (
    "select * replace (case when o_orderpriority = '2-HIGH' then o_totalprice + 1"
    " else o_totalprice end as o_totalprice) from orders"
)


@query(
    " union all ".join(
        [
            f"select {sql_at(0)} as system_time, {sql_at(0)} as event_time, 'I' as observed, * from ({_NOT_OPEN})",
            sql_changes(_NOT_OPEN, _NOT_CLOSED, ["o_orderkey"], ORDERS, 1),
            sql_changes(_NOT_CLOSED, _REPRICED, ["o_orderkey"], ORDERS, 2),
        ]
    )
)
def snapshot_reinsert(spark, sf_dir):
    """Three dumps; what the second one drops returns as an insert with the third."""
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice") + 1)
    base = shared_folder(spark, "reinsert")
    merge = merge_strategy("snapshot", key=["o_orderkey"])
    dumps = [
        orders.filter("o_orderstatus <> 'O'"),
        orders.filter("o_orderstatus <> 'F'"),
        orders.withColumn("o_totalprice", price.otherwise(F.col("o_totalprice"))),
    ]
    for step, dump in enumerate(dumps):
        prev = read_history(spark, f"{base}/data", f"{base}/log")
        rows = merge(prev, dump, system_time=at(step))
        commit(rows, f"{base}/data", f"{base}/log", system_time=datetime.fromisoformat(TIMES[step]), commit_id=f"step-{step}")
    return read_history(spark, f"{base}/data", f"{base}/log")


_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_EVENTS_OLD = "select * from events where ts < timestamp '2024-01-25'"
_EVENTS_NEW = (
    "select * replace (case when event_type = 'purchase' then value * 2 else value end as value)"
    " from events where event_type <> 'error'"
)


@query(sql_changes(_EVENTS_OLD, _EVENTS_NEW, ["user_id", "event_id"], _EVENT_COLUMNS, 1))
def snapshot_compound_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    doubled = F.when(F.col("event_type") == "purchase", F.col("value") * 2)
    new = events.filter("event_type <> 'error'").withColumn(
        "value", doubled.otherwise(F.col("value"))
    )
    history = stored(events.filter(F.col("ts") < "2024-01-25"))
    return snapshot_merge(history, new, key=["user_id", "event_id"], system_time=at(1))


@query("select cast(count(*) - count(*) as bigint) as changes from customer")
def snapshot_no_change_count(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    same = snapshot_merge(stored(customers), customers, key=["c_custkey"], system_time=at(1))
    return same.agg(F.count(F.lit(1)).alias("changes"))


@query(
    f"select a.t as last_seen, b.t as first_new, a.t >= b.t as out_of_order from"
    f" (select max(o_orderdate) as t from ({EARLIER})) a,"
    " (select min(o_orderdate) as t from orders where o_orderstatus = 'O' and"
    " o_orderdate >= timestamp '2000-01-01') b"
)
def event_time_guard(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    first = earlier_orders(orders)
    new = orders.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= "2000-01-01"))
    return event_time_bounds(first, new, "o_orderdate")


_CUTS = [
    "select * from orders where o_orderdate < timestamp '1997-01-01'",
    "select * replace (case when o_orderstatus = 'P' then o_totalprice + 1 else o_totalprice end as"
    " o_totalprice) from orders where o_orderdate < timestamp '1999-01-01' and o_orderstatus <> 'F'",
    "select * replace (nullif(o_orderpriority, '4-NOT SPECIFIED') as o_orderpriority) from orders"
    " where o_orderdate < timestamp '2001-01-01'",
    "select * from orders where o_orderdate >= timestamp '1996-01-01'",
]


@query(
    " union all ".join(
        f"select {sql_at(3)} as system_time, * exclude (system_time) from ({part})"
        for part in [
            f"select {sql_at(0)} as system_time, {sql_at(0)} as event_time, 'I' as observed, * from ({_CUTS[0]})",
            *[
                sql_changes(a, b, ["o_orderkey"], ORDERS, step, null_safe=True)
                for step, (a, b) in enumerate(zip(_CUTS, _CUTS[1:]), start=1)
            ],
        ]
    )
)
def backfill_history_of_dumps(spark, sf_dir):
    """Four dumps of the orders turned into one history in a single pass."""
    orders = table(spark, sf_dir, "orders")
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    cuts = [
        orders.filter(F.col("o_orderdate") < "1997-01-01"),
        orders.filter((F.col("o_orderdate") < "1999-01-01") & (F.col("o_orderstatus") != "F")).withColumn(
            "o_totalprice", F.when(F.col("o_orderstatus") == "P", price + 1).otherwise(price)
        ),
        orders.filter(F.col("o_orderdate") < "2001-01-01").withColumn(
            "o_orderpriority", F.when(priority != "4-NOT SPECIFIED", priority)
        ),
        orders.filter(F.col("o_orderdate") >= "1996-01-01"),
    ]
    dumps = None
    for step, cut in enumerate(cuts):
        cut = cut.withColumn("snapshot_time", at(step))
        dumps = cut if dumps is None else dumps.union(cut)
    return backfill_history(
        dumps,
        key=["o_orderkey"],
        times=[datetime.fromisoformat(t) for t in TIMES],
        system_time=at(3),
    )


def _maps(events, late: bool):
    """A map of a few columns, its entries in another order later; some values appear, some move by a microsecond."""
    moved = F.when(F.lit(late) & (F.col("event_id") % 5 == 0), F.expr("ts + interval 1 microsecond")).otherwise(F.col("ts"))
    entries = [F.lit("seen"), moved, F.lit("ts"), F.col("ts")]
    m = F.create_map(*(entries[2:] + entries[:2] if late else entries))
    here = F.when((F.col("event_id") % 7 != 0) | F.lit(late), m)
    return events.select("event_id", "user_id", here.alias("m"))


def _changed_maps(null_safe: bool) -> str:
    became = "event_id % 7 = 0 or " if null_safe else "event_id % 7 <> 0 and "
    return (
        f"select {sql_at(1)} as system_time, {sql_at(1)} as event_time, 'U' as observed, event_id, user_id,"
        " cast(epoch_us(ts) + case when event_id % 5 = 0 then 1 else 0 end as bigint) as seen from events"
        f" where {became}event_id % 5 = 0"
    )


def _map_changes(spark, sf_dir, null_safe: bool):
    events = table(spark, sf_dir, "events")
    history = stored(_maps(events, False))
    out = snapshot_merge(history, _maps(events, True), key=["event_id"], system_time=at(1), null_safe=null_safe)
    seen = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("m")["seen"])
    return out.select("system_time", "event_time", "observed", "event_id", "user_id", seen.alias("seen"))


@query(_changed_maps(False))
def snapshot_map_changes(spark, sf_dir):
    """Maps are compared by their entries; by default going from NULL is no change."""
    return _map_changes(spark, sf_dir, False)


@query(_changed_maps(True))
def snapshot_map_null_safe(spark, sf_dir):
    return _map_changes(spark, sf_dir, True)
