"""Append merge: every row of the batch is new."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame

from tablelog.functions.columns import (
    Reconciled,
    reconcile,
    reject_reserved,
    time_literal,
    to_front,
    type_of,
)
from tablelog.vocab import DEFAULT_VOCABULARY, Vocabulary


def stamp_and_reconcile(
    prev: DataFrame | None, curr: DataFrame, system_time: datetime | Column, vocab: Vocabulary
) -> Reconciled:
    """Add the system time to the batch, then bring both sides to the same columns."""
    reject_reserved(curr, [vocab.system_time])
    stamp = time_literal(system_time, type_of(prev, vocab.system_time))
    return reconcile(prev, curr.withColumn(vocab.system_time, stamp))


def append_merge(
    prev: DataFrame | None,
    curr: DataFrame,
    *,
    system_time: datetime | Column,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
) -> DataFrame:
    """The batch as it is, under the union of the columns. Lazy; reads no history rows."""
    merged = stamp_and_reconcile(prev, curr, system_time, vocab)
    return to_front(merged.curr, vocab.system_time)
