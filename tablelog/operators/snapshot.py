"""Snapshot merge: turn a full dump into inserts, updates and deletes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.functions.columns import (
    comparable,
    contains_map,
    folded,
    reconcile,
    ref,
    reject_reserved,
    resolved,
    time_literal,
    type_of,
)
from tablelog.functions.keys import HOT_ROWS, KeyProfile, NullSafeKey, profile_keys, replicated, salted, with_pieces
from tablelog.operators.guard import SCAN, check_constant_event_time, check_known_event_time
from tablelog.operators.latest import latest_rows
from tablelog.vocab import DEFAULT_CODES, DEFAULT_VOCABULARY, Codes, Vocabulary


def snapshot_merge(
    prev: DataFrame | None,
    curr: DataFrame,
    *,
    key: Sequence[str],
    system_time: datetime | Column,
    event_time: datetime | Column | None = None,
    compare: Sequence[str] = (),
    null_safe: bool = False,
    codes: Codes = DEFAULT_CODES,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    hot_rows: int = HOT_ROWS,
    last_event_time: datetime | str | None = SCAN,
) -> DataFrame:
    """Rows to append to ``prev`` so that its latest state equals the dump ``curr``.

    Without ``event_time`` the system time is used. ``compare`` limits which columns make a
    row count as changed (all by default). By default a shared column that goes to or from
    NULL is not a change; ``null_safe=True`` makes it one. Of several batch rows with one
    key, the least one that differs from the history is taken.

    Plan: history is reduced to one row per key and meets the batch on the same
    partitioning, so history, batch and batch keys are exchanged once each and duplicates are
    dropped where they are. A full outer join would hold all rows of a key in memory; the
    left and anti joins used instead hold one. A key of ``hot_rows`` rows or more is split into
    pieces of about that size. ``last_event_time`` is the newest event time of the history where
    the caller knows it, NULL if there is none; else the history is scanned for it.
    """
    if event_time is None:
        event_time = system_time
    marks = [vocab.system_time, vocab.event_time, vocab.observed]
    reject_reserved(curr, [vocab.event_time, vocab.observed, vocab.system_time])

    data = reconcile(prev, curr)
    key = resolved(data.curr, key)
    names = [n for n in data.curr.columns if n not in marks]
    keys = NullSafeKey(data.curr, key)
    values = [n for n in names if n not in key]
    compared = compared_columns(data.curr, compare, key, values)
    batch = _packed(data.curr, keys, values, "c")
    if prev is None:
        rows = batch.groupBy(*keys.names).agg(_least("c", data.curr, values).alias("row"))
        rows = rows.withColumn("observed", F.lit(codes.added))
    else:
        profile = profile_keys(data.curr, keys, hot_rows)
        if profile.rows and isinstance(last_event_time, datetime) and isinstance(event_time, datetime):
            check_known_event_time(last_event_time, event_time)
        elif profile.rows and last_event_time is not None:
            check_constant_event_time(prev, event_time, vocab.event_time)
        state = _state(data.prev, keys, values, codes, vocab)
        differs = changed(data.curr, compared, data.added, data.removed, null_safe)
        rows = _differences(batch, state, keys, differs, data.curr, values, codes, profile)
    key_column = dict(zip(key, keys.restored()))
    return rows.select(
        time_literal(system_time, type_of(prev, vocab.system_time)).alias(vocab.system_time),
        time_literal(event_time, type_of(prev, vocab.event_time)).alias(vocab.event_time),
        F.col("observed").alias(vocab.observed),
        *[key_column[n] if n in key_column else ref(n, "row").alias(n) for n in names],
    )


def compared_columns(
    df: DataFrame, compare: Sequence[str], key: Sequence[str], values: Sequence[str]
) -> list[str]:
    if not compare:
        return list(values)
    fold = folded(df.sparkSession)
    known = {fold(n): n for n in df.columns}
    unknown = [n for n in compare if fold(n) not in known]
    if unknown:
        raise ValueError("Column does not exist: " + ", ".join(unknown))
    # A key column is equal on both sides by definition of the join.
    return [known[fold(n)] for n in compare if known[fold(n)] not in key]


def _packed(df: DataFrame, keys: NullSafeKey, values: Sequence[str], name: str) -> DataFrame:
    """Derived key columns plus one struct, whose presence alone says the side has a row."""
    row = F.struct(F.lit(True).alias("__here"), *map(ref, values))
    return df.select(*keys.columns, row.alias(name))


def _state(
    prev: DataFrame, keys: NullSafeKey, values: Sequence[str], codes: Codes, vocab: Vocabulary
) -> DataFrame:
    """Latest live row per key of the history, as struct ``p``."""
    rest = [vocab.event_time, vocab.system_time, vocab.observed, *values]
    series = prev.select(*keys.columns, *map(ref, rest))
    latest = latest_rows(series, keys.names, rest, vocab.event_time, [vocab.system_time])
    return latest.filter(ref(vocab.observed, "row") != codes.removed).select(
        *keys.names,
        F.struct(F.lit(True).alias("__here"), *[ref(v, "row").alias(v) for v in values]).alias("p"),
    )


def changed(
    df: DataFrame,
    compared: Sequence[str],
    added: set[str],
    removed: set[str],
    null_safe: bool,
    was: Column | None = None,
    now: Column | None = None,
) -> Column:
    """Whether the struct ``now`` differs from the struct ``was``, by default columns ``c`` and ``p``."""
    was, now = F.col("p") if was is None else was, F.col("c") if now is None else now
    tests: list[Column] = []
    for name in compared:
        kind = df.schema[name].dataType
        before = comparable(was[name], kind)
        after = comparable(now[name], kind)
        if name in added:
            tests.append(now[name].isNotNull())
        elif name in removed:
            tests.append(was[name].isNotNull())
        elif null_safe:
            tests.append(~before.eqNullSafe(after))
        else:
            tests.append(before != after)
    return F.coalesce(reduce(or_, tests, F.lit(False)), F.lit(False))


def _least(name: str, df: DataFrame, values: Sequence[str]) -> Column:
    """Aggregate: the least of the structs in column ``name``, NULL structs ignored."""
    kinds = {v: df.schema[v].dataType for v in values}
    if not any(map(contains_map, kinds.values())):
        return F.min(name)
    order = F.struct(*[comparable(ref(v, name), kinds[v]).alias(v) for v in values])
    return F.min_by(name, F.when(F.col(name).isNotNull(), order))


def _differences(
    batch: DataFrame,
    state: DataFrame,
    keys: NullSafeKey,
    changed: Column,
    df: DataFrame,
    values: Sequence[str],
    codes: Codes,
    profile: KeyProfile,
) -> DataFrame:
    """Key, observation code and row struct of every key that differs."""
    on = list(keys.names)
    at, dump, known_rows = on, batch, state
    gone, present = state, batch.select(*on)
    if profile.hot:
        spread = [ref(v, "c") for v in values if not contains_map(df.schema[v].dataType)]
        dump = salted(batch, keys, profile, spread or [F.lit(0)])
        known_rows = replicated(state, keys, profile)
        at = [*on, "__salt"]
        # Few keys, though many rows: settled apart, so the rest has no heavy key.
        marked = with_pieces(present, keys, profile)
        heavy = marked.filter("__pieces > 1").select(*on).distinct()
        gone = state.join(F.broadcast(heavy), on, "left_anti")
        present = marked.filter("__pieces = 1").select(*on)
    known = F.col("p").isNotNull()
    fresh = (
        dump.join(known_rows, at, "left")
        .filter(~known | changed)
        .groupBy(*on)
        .agg(_least("c", df, values).alias("row"), F.bool_or(known).alias("known"))
    )
    observed = F.when(F.col("known"), codes.changed).otherwise(codes.added)
    return fresh.select(*on, "row", observed.alias("observed")).union(
        gone.join(present, on, "left_anti").select(
            *on, F.col("p").alias("row"), F.lit(codes.removed).alias("observed")
        )
    )
