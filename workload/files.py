"""Queries that go through files: raw input, commits, streams, archives, GeoJSON.

The files are derived from the given tables by Spark and lie in the shared folder.
"""

from __future__ import annotations

import bz2
import io
import zipfile
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelog import (
    IngestTask,
    Source,
    commit,
    corrupt_records,
    expand_archives,
    ingest_all,
    merge_strategy,
    poll,
    poll_ledger,
    read_geojson,
    read_history,
    read_log,
    read_raw,
    reject_corrupt,
)
from workload.base import EARLIER, LATER, ORDERS, TIMES, earlier_orders, later_orders, query, sql_changes, table
from workload.sql import ORDER_JSON, exact_orders, sql_digest
from workload.workspace import shared_folder

_INSTANTS = [datetime.fromisoformat(t).replace(tzinfo=timezone.utc) for t in TIMES]
_DDL = (
    "o_orderkey BIGINT",
    "o_custkey BIGINT",
    "o_orderstatus STRING",
    "o_totalprice DOUBLE",
    "o_orderdate TIMESTAMP_NTZ",
    "o_orderpriority STRING",
)


def _seconds(name: str):
    """Instants as numbers, which look the same in any session time zone."""
    return F.unix_seconds(name).alias(name)


def _csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


@query("select * from orders")
def read_csv(spark, sf_dir):
    path = _csv(table(spark, sf_dir, "orders"), shared_folder(spark, "csv"))
    return reject_corrupt(read_raw(spark, path, "csv", {"header": "true"}, _DDL))


_JSON_LINE = (
    """'{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '","user_id":' || user_id"""
    """ || ',"event_type":"' || event_type || '","value":"' || cast(cast(round(value * 1000) as bigint) as varchar)"""
    """ || '","props":' || to_json(props) || '}'"""
)


def _event_lines(spark, sf_dir, cut: bool) -> str:
    """Events as JSON lines; ``cut`` leaves the last bracket off those of type error."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        "event_type",
        F.round(F.col("value") * 1000).cast("bigint").cast("string").alias("value"),
        "props",
    )
    line = F.to_json(F.struct("*"))
    if cut:
        line = F.when(F.col("event_type") == "error", F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    path = shared_folder(spark, "lines")
    events.select(line.alias("value")).write.text(path)
    return path


_EVENT_DDL = ("event_id BIGINT", "ts STRING", "user_id BIGINT", "event_type STRING", "value STRING", "props STRING")


@query(f"select {_JSON_LINE[:-7]} as _corrupt_record from events where event_type = 'error'")
def corrupt_json_records(spark, sf_dir):
    raw = read_raw(spark, _event_lines(spark, sf_dir, cut=True), "json", schema=_EVENT_DDL)
    return corrupt_records(raw).select("_corrupt_record")


@query(
    "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, user_id, event_type,"
    " cast(cast(round(value * 1000) as bigint) as varchar) as value, props from events"
)
def corrupt_gate(spark, sf_dir):
    raw = read_raw(spark, _event_lines(spark, sf_dir, cut=False), "json", schema=_EVENT_DDL)
    return reject_corrupt(raw)


@query(
    "select 'first' as commit_id, cast(1 as bigint) as sequence, '' as prev_block_hash, hash, num_records,"
    f" '{_INSTANTS[0].isoformat()}' as interval_start, '{_INSTANTS[0].isoformat()}' as interval_end"
    f" from ({sql_digest(ORDER_JSON, 'select * from orders')})"
)
def commit_record(spark, sf_dir):
    base = shared_folder(spark, "commit")
    commit(
        exact_orders(spark, sf_dir),
        f"{base}/data",
        f"{base}/log",
        system_time=_INSTANTS[0],
        commit_id="first",
    )
    return read_log(spark, f"{base}/log").select(
        "commit_id", "sequence", "prev_block_hash", "hash", "num_records", "interval_start", "interval_end"
    )


@query(
    "select o_orderkey, o_custkey, cast(null as varchar) as o_orderpriority, o_totalprice from orders"
    " union all select o_orderkey, cast(null as bigint), o_orderpriority, o_totalprice from orders"
)
def schema_evolution_roundtrip(spark, sf_dir):
    """A history whose second commit brings one column and lacks another."""
    base = shared_folder(spark, "evolution")
    orders = table(spark, sf_dir, "orders")
    merge = merge_strategy("append")
    for step, columns in enumerate(
        [["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderkey", "o_orderpriority", "o_totalprice"]]
    ):
        prev = read_history(spark, f"{base}/data", f"{base}/log")
        rows = merge(prev, orders.select(*columns), system_time=_INSTANTS[step])
        commit(
            rows, f"{base}/data", f"{base}/log", system_time=_INSTANTS[step], commit_id=f"step-{step}"
        )
    log = read_history(spark, f"{base}/data", f"{base}/log")
    return log.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


@query(
    "select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F'"
    " union all select o_orderkey, null, null from orders where o_orderstatus = 'O'"
    " union all select o_orderkey, null, o_totalprice from orders where o_orderstatus = 'P'"
)
def commit_narrow_after_wide(spark, sf_dir):
    """Commits that lack columns of the table; what was stored stays readable."""
    base = shared_folder(spark, "narrow")
    orders = table(spark, sf_dir, "orders")
    for step, (status, columns) in enumerate(
        [("F", ["o_orderkey", "o_custkey", "o_totalprice"]), ("O", ["o_orderkey"]), ("P", ["o_totalprice", "o_orderkey"])]
    ):
        rows = orders.filter(F.col("o_orderstatus") == status).select(*columns)
        commit(rows, f"{base}/data", f"{base}/log", system_time=_INSTANTS[step], commit_id=f"step-{step}")
    return read_history(spark, f"{base}/data", f"{base}/log")


@query("select * from orders")
def ingest_two_files_one_time(spark, sf_dir):
    """Two files at one system time; one of them again, which adds nothing."""
    base = shared_folder(spark, "same-time")
    orders = table(spark, sf_dir, "orders")
    paths = [
        _csv(orders.filter(F.col("o_orderstatus") == "O"), f"{base}/open"),
        _csv(orders.filter(F.col("o_orderstatus") != "O"), f"{base}/others"),
    ]
    source = Source(format="csv", options={"header": "true"}, schema=_DDL)
    tasks = [
        IngestTask("orders", source, path, f"{base}/data", f"{base}/log", system_time=_INSTANTS[0])
        for path in [*paths, paths[0]]
    ]
    ingest_all(spark, tasks)
    return read_history(spark, f"{base}/data", f"{base}/log").select(*ORDERS)


@query("select * from events")
def stream_two_checkpoints(spark, sf_dir):
    """Two streams on one table; both begin with batch 0."""
    base = shared_folder(spark, "streams")
    events = table(spark, sf_dir, "events")
    for i, part in enumerate((events.filter("event_type <> 'click'"), events.filter("event_type = 'click'"))):
        part.write.parquet(f"{base}/raw{i}")
        poll(
            spark.readStream.schema(events.schema).parquet(f"{base}/raw{i}"),
            merge=merge_strategy("append"),
            data_dir=f"{base}/data",
            log_dir=f"{base}/log",
            checkpoint=f"{base}/checkpoint{i}",
            system_time=lambda batch_id: _INSTANTS[0],
        ).awaitTermination()
    return read_history(spark, f"{base}/data", f"{base}/log").drop("system_time")


def _ingest_dumps(spark, sf_dir, merge: str) -> DataFrame:
    base = shared_folder(spark, "ingest")
    orders = table(spark, sf_dir, "orders")
    source = Source(
        format="csv",
        options={"header": "true"},
        schema=_DDL,
        preprocess=(
            ("select *, upper(o_orderpriority) as priority from input", "named"),
            ("select * except (o_orderpriority, priority), priority as o_orderpriority from named", "output"),
        ),
        merge=merge,
        merge_params={"key": ["o_orderkey"]},
    )
    tasks = [
        IngestTask(
            dataset_id="orders",
            source=source,
            data_to_ingest=_csv(dump, f"{base}/raw{step}"),
            data_dir=f"{base}/data",
            log_dir=f"{base}/log",
            system_time=_INSTANTS[step],
        )
        for step, dump in enumerate([earlier_orders(orders), later_orders(orders)])
    ]
    ingest_all(spark, tasks)
    return read_history(spark, f"{base}/data", f"{base}/log")


_EPOCHS = [int(t.timestamp()) for t in _INSTANTS]


@query(
    f"select cast({_EPOCHS[0]} as bigint) as system_time, * from ({EARLIER}) union all"
    f" select cast({_EPOCHS[1]} as bigint), c.* from ({LATER}) c where not exists"
    f" (select 1 from ({EARLIER}) p where p.o_orderkey = c.o_orderkey)"
)
def ingest_ledger(spark, sf_dir):
    """Two CSV dumps through the whole pipeline."""
    return _ingest_dumps(spark, sf_dir, "ledger").select(_seconds("system_time"), *ORDERS)


@query(
    f"select cast({_EPOCHS[0]} as bigint) as event_time, 'I' as observed, * from ({EARLIER}) union all"
    f" select cast({_EPOCHS[1]} as bigint), * exclude (system_time, event_time) from"
    f" ({sql_changes(EARLIER, LATER, ['o_orderkey'], ORDERS, 1)})"
)
def ingest_snapshot(spark, sf_dir):
    log = _ingest_dumps(spark, sf_dir, "snapshot")
    return log.select(_seconds("event_time"), "observed", *ORDERS)


@query("select * from events")
def stream_ledger(spark, sf_dir):
    """Two polls of a folder; the second finds mostly rows the first has already stored."""
    base = shared_folder(spark, "stream")
    events = table(spark, sf_dir, "events")
    for part in (events.filter("event_type <> 'click'"), events):
        part.write.mode("append").parquet(f"{base}/raw")
        poll(
            spark.readStream.schema(events.schema).parquet(f"{base}/raw"),
            merge=merge_strategy("ledger", key=["event_id"]),
            data_dir=f"{base}/data",
            log_dir=f"{base}/log",
            checkpoint=f"{base}/checkpoint",
            system_time=lambda batch_id: _INSTANTS[0],
        ).awaitTermination()
    return read_history(spark, f"{base}/data", f"{base}/log").drop("system_time")


_SPANS = [datetime(2024, 1, 3), datetime(2024, 1, 6)]


@query(
    f"with b as (select *, case when ts < timestamp '{_SPANS[0]}' then 0 when ts < timestamp '{_SPANS[1]}' then 1 else 2 end as batch from events)"
    " select * exclude (batch) from b qualify batch = min(batch) over (partition by user_id, event_type)"
)
def stream_ledger_state(spark, sf_dir):
    """Two batches whose seen users and types are in the state store, which begins with the history's."""
    base = shared_folder(spark, "states")
    events = table(spark, sf_dir, "events")
    where = {"data_dir": f"{base}/data", "log_dir": f"{base}/log"}
    before = [F.col("ts") < F.lit(str(t)).cast("timestamp_ntz") for t in _SPANS]
    commit(events.filter(before[0]), **where, system_time=_INSTANTS[0], commit_id="history", event_time_column="ts")
    for part in (events.filter(before[1]), events):
        part.write.mode("append").parquet(f"{base}/raw")
        poll_ledger(
            spark.readStream.schema(events.schema).parquet(f"{base}/raw"),
            key=["user_id", "event_type"],
            **where,
            checkpoint=f"{base}/checkpoint",
            system_time=lambda batch_id: _INSTANTS[1],
        ).awaitTermination()
    return read_history(spark, **where).drop("system_time")


@query(
    "select cast(doc_id as varchar) as path, 'body/text.txt' as member, md5(text) as digest,"
    " cast(octet_length(encode(text)) as bigint) as bytes from documents"
)
def document_archives(spark, sf_dir):
    """Every document packed as bzip2 around ZIP, and its text member taken out again."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for text, lang in zip(batch["text"], batch["lang"]):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("body/text.txt", text)
                    archive.writestr("lang.meta", lang)
                packed.append(bz2.compress(out.getvalue(), 1))
            yield pd.DataFrame({"path": batch["path"], "content": packed})

    documents = table(spark, sf_dir, "documents")
    packed = documents.select(F.col("doc_id").cast("string").alias("path"), "text", "lang").mapInPandas(
        pack, "path string, content binary"
    )
    members = expand_archives(packed, pattern=r".*\.txt", bz2=True)
    return members.select(
        "path",
        "member",
        F.md5("content").alias("digest"),
        F.octet_length("content").cast("bigint").alias("bytes"),
    )


_XY = "s_nationkey || ' ' || s_suppkey"


@query(
    "select case s_nationkey % 3 "
    f"when 0 then 'POINT (' || {_XY} || ')'"
    f" when 1 then 'LINESTRING (' || {_XY} || ', 0 1)'"
    f" else 'POLYGON ((' || {_XY} || ', 0 1, 2 3, ' || {_XY} || '))' end as geometry,"
    " cast(s_suppkey as varchar) as key, s_name as name from supplier"
)
def geojson_features(spark, sf_dir):
    """Suppliers as GeoJSON lines with points, lines and polygons, read back as WKT."""
    suppliers = table(spark, sf_dir, "supplier")
    kind = F.col("s_nationkey") % 3
    position = F.format_string("[%s, %s]", "s_nationkey", "s_suppkey")
    geometry = (
        F.when(kind == 0, F.concat(F.lit('{"type":"Point","coordinates":'), position))
        .when(kind == 1, F.concat(F.lit('{"type":"LineString","coordinates":['), position, F.lit(",[0,1]]")))
        .otherwise(
            F.concat(
                F.lit('{"type":"Polygon","coordinates":[['), position, F.lit(",[0,1],[2,3],"), position, F.lit("]]")
            )
        )
    )
    properties = F.to_json(F.struct(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}}")
    )
    path = shared_folder(spark, "geojson")
    suppliers.select(feature.alias("value")).write.text(path)
    return reject_corrupt(read_geojson(spark, path, lines=True))


_PLACE = "cast(s_nationkey as varchar) || ' ' || cast(s_suppkey as varchar)"
# Per type: the JSON of the coordinates (or geometries) and the WKT, with @ for a place.
_TYPES = [
    ("Point", '"coordinates":@', "POINT (@)"),
    ("MultiPoint", '"coordinates":[@,[1.5,-2]]', "MULTIPOINT ((@), (1.5 -2))"),
    ("LineString", '"coordinates":[@,[0,1000]]', "LINESTRING (@, 0 1000)"),
    ("Polygon", '"coordinates":[[@,[0,1],[2,3],@]]', "POLYGON ((@, 0 1, 2 3, @))"),
    ("MultiLineString", '"coordinates":[[@,[0,1]],[[2,3],@]]', "MULTILINESTRING ((@, 0 1), (2 3, @))"),
    ("MultiPolygon", '"coordinates":[[[@,[0,1],[2,3],@]],[[[4,5],@,[6,7],[4,5]]]]', "MULTIPOLYGON (((@, 0 1, 2 3, @)), ((4 5, @, 6 7, 4 5)))"),
    ("GeometryCollection", '"geometries":[{"type":"Point","coordinates":@},{"type":"LineString","coordinates":[@,[0,1]]}]', "GEOMETRYCOLLECTION (POINT (@), LINESTRING (@, 0 1))"),
]


def _feature(text: str):
    """A template with every @ replaced by the supplier's place."""
    pair = F.format_string("[%s,%s]", "s_nationkey", "s_suppkey")
    return F.replace(F.lit(text), F.lit("@"), pair)


def _typed_features(spark, sf_dir) -> DataFrame:
    kind = F.col("s_suppkey") % len(_TYPES)
    geometry = F.lit("")
    for i, (name, body, _) in enumerate(_TYPES):
        geometry = F.when(kind == i, F.concat(F.lit(f'{{"type":"{name}",'), _feature(body), F.lit("}"))).otherwise(geometry)
    properties = F.to_json(F.struct(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))
    text = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("value"))


#: Features of a collection, about. A task reads one as a whole, unless it is split.
_MOST_FEATURES = {"collections": 20_000, "split": 500_000}


def _collections(spark, sf_dir, purpose: str, files: int) -> str:
    """Collections of one file each that span lines, ``files`` at least; the path of their folders."""
    value = _typed_features(spark, sf_dir).select("value")
    many = max(files, -(-value.count() // _MOST_FEATURES[purpose]))
    group = F.pmod(F.xxhash64("value"), F.lit(many)).alias("g")
    ends = [F.lit('{"type":"FeatureCollection",\n"features":['), F.lit("]}")]
    around = [spark.range(many).select(F.col("id").alias("g"), F.lit(2 * i).alias("part"), end.alias("value")) for i, end in enumerate(ends)]
    rows = value.select(group, F.lit(1).alias("part"), "value").unionByName(around[0]).unionByName(around[1])
    # Sorted and written row by row, so that no task holds a collection.
    after = F.lead("part").over(Window.partitionBy("g").orderBy("part", "value"))
    rows = rows.withColumn("line", F.concat("value", F.when((F.col("part") == 1) & (after == 1), ",").otherwise("")))
    path = shared_folder(spark, purpose)
    rows.sortWithinPartitions("g", "part", "value").select("g", "line").write.partitionBy("g").text(path)
    return f"{path}/g=*"


@query(
    "select cast(s_suppkey as varchar) as key, s_name as name, case s_suppkey % 7 "
    + " ".join(f"when {i} then replace('{wkt}', '@', {_PLACE})" for i, (_, _, wkt) in enumerate(_TYPES))
    + " end as geometry from supplier"
)
def geojson_all_types(spark, sf_dir):
    """Every geometry type, in collections of one file each that span lines."""
    path = _collections(spark, sf_dir, "collections", files=3)
    return reject_corrupt(read_geojson(spark, path, properties=["key", "name"]))


@query(
    "select cast(s_suppkey as varchar) as key, s_name as name, case s_suppkey % 7 "
    + " ".join(f"when {i} then replace('{wkt}', '@', {_PLACE})" for i, (_, _, wkt) in enumerate(_TYPES))
    + " end as geometry from supplier"
)
def geojson_split(spark, sf_dir):
    """The same collections, each cut between its features and read by several tasks."""
    path = _collections(spark, sf_dir, "split", files=2)
    return reject_corrupt(read_geojson(spark, path, properties=["key", "name"], split=True))


_OPEN = "s_suppkey % 7 in (3, 5) and s_suppkey % 5 = 3"


@query(f"select 's' || s_suppkey as record from supplier where s_suppkey % 5 < 3 or {_OPEN}")
def geojson_corrupt(spark, sf_dir):
    """Features of which some are cut off, misnamed, lack an ordinate or have an open ring; the names of these."""
    value = F.col("value")
    cut = F.substring(value, F.lit(1), F.length(value) - 1)
    bad = (
        F.when(F.col("s_suppkey") % 5 == 0, cut)
        .when(F.col("s_suppkey") % 5 == 1, F.replace(value, F.lit('"Feature"'), F.lit('"Fixture"')))
        .when(F.col("s_suppkey") % 5 == 2, F.regexp_replace(value, r"\[(\d+),\d+\]", "[$1,null]"))
        .when(F.expr(_OPEN), F.regexp_replace(value, r"\[(\d+),(\d+)\]\]\]", "[$1,99$2]]]"))
        .otherwise(value)
    )
    path = shared_folder(spark, "broken")
    _typed_features(spark, sf_dir).select(bad.alias("value")).write.text(path)
    broken = corrupt_records(read_geojson(spark, path, lines=True, properties=["key"]))
    key = F.regexp_extract("_corrupt_record", r'key\W+(\d+)', 1)
    return broken.select(F.concat(F.lit("s"), key).alias("record"))
