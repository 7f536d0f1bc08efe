"""Ledger merge: only rows whose key the history has never seen."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.functions.columns import ref, resolved, to_front
from tablelog.functions.keys import BROADCAST_BYTES, NullSafeKey
from tablelog.operators.append import stamp_and_reconcile
from tablelog.vocab import DEFAULT_VOCABULARY, Vocabulary


def ledger_merge(
    prev: DataFrame | None,
    curr: DataFrame,
    *,
    key: Sequence[str],
    system_time: datetime | Column,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``curr`` with an unseen key; NULL keys match NULL keys.

    Duplicates inside the batch are kept, and changed data under a known key is ignored.
    Of the history only the key columns are read.

    * A batch whose counted key bytes are small is broadcast, so no history row is shuffled.
    * Otherwise history keys and batch meet in one exchange each. History keys are made distinct
      per task before theirs, so a heavy one sends one row per task; a key that is heavy in the
      batch is split by adaptive execution, which the anti join allows on that side.
    """
    merged = stamp_and_reconcile(prev, curr, system_time, vocab)
    keys = NullSafeKey(merged.curr, resolved(merged.curr, key))
    if prev is None:
        return to_front(merged.curr, vocab.system_time)
    columns = [ref(c) for c in merged.curr.columns]
    batch = merged.curr.select(*columns, *keys.columns)
    seen = merged.prev.select(*keys.columns)
    on = keys.names
    size = merged.curr.agg(F.sum(keys.bytes())).first()[0] or 0
    if size <= broadcast_bytes:
        seen = seen.join(F.broadcast(batch.select(*on)), on, "left_semi").distinct()
        # At most the batch's own distinct keys, so under the same bound.
        fresh = batch.join(F.broadcast(seen), on, "left_anti")
    else:
        fresh = batch.join(seen.distinct(), on, "left_anti")
    return to_front(fresh.select(*columns), vocab.system_time)
