"""Ledger ingest of a stream whose seen keys lie in Spark's state store.

The merge of a batch with the history scans the keys of the history each time. Here a key's state says
that it was seen. The state is seeded once, when the stream starts from a new checkpoint, with the
keys of the history; from then on a batch reads its own rows and the state of their keys, and the history is
written to but not read. The state is part of the stream's checkpoint, so a restarted stream goes on
from it, and a batch that is delivered again meets the state that it met before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tablelog.functions.columns import folded, ref, resolved
from tablelog.functions.keys import NullSafeKey
from tablelog.operators.append import append_merge
from tablelog.sources.history import names_in, open_log, read_history
from tablelog.streaming.polling import commit_batch, now
from tablelog.vocab import DEFAULT_VOCABULARY, Vocabulary

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _FirstSeen(StatefulProcessor):
    """Passes on the rows of keys that have no state, and gives these keys one."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known, made = self.seen.exists(), Row(*self.names)
        if not known:
            self.seen.update((True,))
        for row in rows:
            if not known:
                yield made(*[row[n] for n in self.names])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def poll_ledger(
    stream: DataFrame,
    *,
    key: list[str],
    data_dir: str,
    log_dir: str,
    checkpoint: str,
    system_time: Callable[[int], datetime] = now,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
) -> StreamingQuery:
    """Ingest a stream by the ledger rule: rows whose key neither history nor stream has seen.

    As ``poll`` with the ledger merge, duplicates inside one batch are kept, NULL keys match NULL keys, and
    every batch is a commit under its own id. The table must have no other writer while the
    stream lives, since keys that others add reach the state only with a new checkpoint. ``prepare`` is applied
    to the stream. A task holds the rows that one key has in one batch, so limit what a trigger takes. The session's state store must be RocksDB, which this sets where nothing else is set.
    """
    spark = stream.sparkSession
    if prepare is not None:
        stream = prepare(stream)
    key = resolved(stream, key)
    names = stream.columns
    keyed = NullSafeKey(stream, key)
    rows = stream.select(*map(ref, names), *keyed.columns)
    seeds = _seeds(spark, stream, key, data_dir, log_dir, checkpoint)
    if not spark.conf.get(_PROVIDER, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKS)
    fresh = rows.groupBy(*keyed.names).transformWithState(_FirstSeen(names), stream.schema, "Append", "None", initialState=seeds.groupBy(*keyed.names))

    def merge(prev, curr, *, system_time, event_time=None, **known) -> DataFrame:
        return append_merge(prev, curr, system_time=system_time, vocab=vocab)

    def one(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, batch_id, merge=merge, data_dir=data_dir, log_dir=log_dir, system_time=system_time, checkpoint=checkpoint, schema_only=True)

    return (
        fresh.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _seeds(spark: SparkSession, stream: DataFrame, key: list[str], data_dir: str, log_dir: str, checkpoint: str) -> DataFrame:
    """The distinct keys of the history, none if the checkpoint has a finished batch."""
    like = stream.select(*map(ref, key))
    empty = spark.createDataFrame([], like.schema)
    started = any(n.isdigit() for n in names_in(spark, f"{checkpoint.rstrip('/')}/commits"))
    log = open_log(spark, log_dir)
    prev = None if started or not log.last else read_history(spark, data_dir, log=log)
    seeds = empty
    if prev is not None:
        fold = folded(spark)
        held = {fold(f.name): f for f in prev.schema}
        columns = []
        for f in like.schema:
            own = held.get(fold(f.name))
            if own is None:  # a key column that is new: all stored rows have NULL there
                value = F.lit(None).cast(f.dataType)
            elif own.dataType == f.dataType:
                value = ref(own.name)
            else:  # a key that does not fit the stream's type cannot come again
                value = ref(own.name).try_cast(f.dataType)
            columns.append(value.alias(f.name))
        seeds = prev.select(*columns)
    return seeds.select(*NullSafeKey(like, key).columns).distinct()
