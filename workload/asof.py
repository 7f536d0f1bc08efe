"""Point-in-time views of an event series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelog import as_of
from workload.base import query, table

_LATEST = (
    "select * exclude (rn) from (select *, row_number() over (partition by {key}"
    " order by ts desc, event_id desc) as rn from ({rows})) where rn = 1 and event_type <> 'error'"
)


@query(_LATEST.format(key="user_id", rows="select * from events"))
def as_of_latest(spark, sf_dir):
    return as_of(
        table(spark, sf_dir, "events"), ["user_id"], "ts", observed="event_type", removed="error"
    )


@query(
    _LATEST.format(
        key="user_id", rows="select * from events where ts <= timestamp '2024-01-15 12:00:00'"
    )
)
def as_of_time(spark, sf_dir):
    return as_of(
        table(spark, sf_dir, "events"),
        ["user_id"],
        "ts",
        at=F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"),
        observed="event_type",
        removed="error",
    )


@query(
    _LATEST.format(key="user_id, day", rows="select *, cast(ts as date) as day from events")
)
def as_of_compound_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return as_of(events, ["user_id", "day"], "ts", observed="event_type", removed="error")
