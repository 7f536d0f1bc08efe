"""One row per key: the latest of a series, or the least of a set of duplicates.

Both are ``max``/``min`` of a struct. The aggregate combines on the map side, so a key
with any number of rows sends one row per task into the shuffle, and nothing is sorted
globally. Ordering by the whole row makes ties come out the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.functions.columns import comparable, contains_map, ref, time_literal, type_of


def ordered_struct(df: DataFrame, names: Sequence[str]) -> Column:
    return F.struct(*[comparable(ref(n), df.schema[n].dataType).alias(n) for n in names])


def extreme_row(df: DataFrame, names: Sequence[str], *, greatest: bool) -> Column:
    """Aggregate: the struct of ``names`` that orders last (or first) within the group."""
    row = F.struct(*map(ref, names))
    if any(contains_map(df.schema[n].dataType) for n in names):
        order = ordered_struct(df, names)
        return F.max_by(row, order) if greatest else F.min_by(row, order)
    return F.max(row) if greatest else F.min(row)


def latest_rows(
    series: DataFrame,
    group: Sequence[str],
    rest: Sequence[str],
    time: str,
    ties: Sequence[str] = (),
) -> DataFrame:
    """``group`` columns plus the latest row as struct ``row``; NULL times come first."""
    first = [c for c in dict.fromkeys([time, *ties]) if c in rest]
    order = first + [c for c in rest if c not in first]
    return series.groupBy(*map(ref, group)).agg(
        extreme_row(series, order, greatest=True).alias("row")
    )


def as_of(
    series: DataFrame,
    key: Sequence[str],
    time: str = "event_time",
    at: datetime | Column | None = None,
    observed: str = "observed",
    removed: str = "D",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Project a change history onto one point in time (the latest when ``at`` is None).

    The bound is inclusive. Keys last seen as ``removed``, or with a NULL observation,
    are absent from the result.
    """
    if at is not None:
        series = series.filter(ref(time) <= time_literal(at, type_of(series, time)))
    rest = [c for c in series.columns if c not in key]
    rows = latest_rows(series, key, rest, time, ties)
    return rows.filter(ref(observed, "row") != removed).select(
        *[(ref(c) if c in key else ref(c, "row")).alias(c) for c in series.columns]
    )


def one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Drop duplicates by key, keeping the least row (NULLs first), the same on every run."""
    rest = [*order, *[c for c in df.columns if c not in key and c not in order]]
    if not rest:
        return df.distinct()
    rows = df.groupBy(*map(ref, key)).agg(extreme_row(df, rest, greatest=False).alias("row"))
    return rows.select(
        *[(ref(c) if c in key else ref(c, "row")).alias(c) for c in df.columns]
    )
