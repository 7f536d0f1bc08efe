"""Event time may only move forward in a snapshot history."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.functions.columns import ref, time_literal, type_of


# The newest event time is not known beforehand.
SCAN = "scan"


class PastEventTime(ValueError):
    """A snapshot is not newer than what the history already holds."""


def event_time_bounds(prev: DataFrame, curr: DataFrame, column: str) -> DataFrame:
    """One row: newest history time, oldest batch time, and whether they are out of order.

    Both ends come from one aggregation over one column of each side. An empty side gives
    NULL, which is never out of order; equal times are.
    """
    kind = type_of(prev, column)
    sides = prev.select(ref(column).alias("seen"), F.lit(None).cast(kind).alias("incoming")).unionAll(
        curr.select(F.lit(None).cast(kind).alias("seen"), ref(column).cast(kind).alias("incoming"))
    )
    ends = sides.agg(F.max("seen").alias("last_seen"), F.min("incoming").alias("first_new"))
    late = F.coalesce(F.col("last_seen") >= F.col("first_new"), F.lit(False))
    return ends.select("last_seen", "first_new", late.alias("out_of_order"))


def check_event_time(prev: DataFrame, curr: DataFrame, column: str = "event_time") -> None:
    row = event_time_bounds(prev, curr, column).first()
    if row["out_of_order"]:
        _refuse(row["last_seen"], row["first_new"])


def check_constant_event_time(prev: DataFrame, event_time: datetime | Column, column: str) -> None:
    """The same check for a non-empty batch with one event time: only history is read."""
    newest = time_literal(event_time, type_of(prev, column))
    row = (
        prev.agg(F.max(ref(column)).alias("last_seen"))
        .select("last_seen", newest.alias("first_new"))
        .withColumn("late", F.col("last_seen") >= F.col("first_new"))
        .first()
    )
    if row["late"]:
        _refuse(row["last_seen"], row["first_new"])


def check_known_event_time(last: datetime, event_time: datetime) -> None:
    """The same check where the newest time of the history is known, from its commit log."""
    utc = lambda t: t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t
    if utc(last) >= utc(event_time):
        _refuse(last, event_time)


def _refuse(last_seen, first_new) -> None:
    raise PastEventTime(
        f"A snapshot must be newer than the history, but {first_new} is not after {last_seen}"
    )
