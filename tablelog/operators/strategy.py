"""Choosing a merge by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame

from tablelog.operators.append import append_merge
from tablelog.operators.guard import SCAN
from tablelog.operators.ledger import ledger_merge
from tablelog.operators.snapshot import snapshot_merge
from tablelog.vocab import DEFAULT_VOCABULARY, Vocabulary

Merge = Callable[..., DataFrame]


def merge_strategy(
    kind: str, *, vocab: Vocabulary = DEFAULT_VOCABULARY, **params: Any
) -> Merge:
    """A function ``(prev, curr, *, system_time, event_time=None, last_event_time) -> new rows``.

    ``append`` takes no parameters, ``ledger`` a ``key``, ``snapshot`` a ``key`` and
    optionally ``compare``, ``null_safe`` and ``codes``.
    """
    merges = {"append": append_merge, "ledger": ledger_merge, "snapshot": snapshot_merge}
    if kind not in merges:
        raise NotImplementedError(f"Unsupported strategy: {kind}")
    if kind != "append" and not params.get("key"):
        raise ValueError(f"Strategy {kind} needs a key")

    def merge(
        prev: DataFrame | None,
        curr: DataFrame,
        *,
        system_time: datetime | Column,
        event_time: datetime | Column | None = None,
        last_event_time: datetime | str | None = SCAN,
    ) -> DataFrame:
        extra = {"event_time": event_time, "last_event_time": last_event_time} if kind == "snapshot" else {}
        return merges[kind](prev, curr, system_time=system_time, vocab=vocab, **params, **extra)

    return merge
