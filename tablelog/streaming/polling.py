"""Continuous ingest: every micro-batch becomes one commit."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tablelog.operators.strategy import Merge
from tablelog.plans.ingest import merge_with_existing
from tablelog.sources.history import commit, open_log


def now(batch_id: int) -> datetime:
    return datetime.now(timezone.utc)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream when it first writes to its checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def commit_batch(
    batch: DataFrame,
    batch_id: int,
    *,
    merge: Merge,
    data_dir: str,
    log_dir: str,
    system_time: Callable[[int], datetime] = now,
    event_time: Callable[[int], datetime] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    stream_id: str = "",
    checkpoint: str = "",
    schema_only: bool = False,
) -> None:
    """Merge and commit one micro-batch under its id.

    A micro-batch may be delivered again after a failure. Its commit id is derived from the
    stream's id, which lies in its checkpoint, and the batch id, so a recorded one is skipped,
    and one that was written but not recorded is neither read nor kept. Another stream, or the
    same one from a new checkpoint, has other ids. Give the id, or the checkpoint that holds it.
    With ``schema_only`` the merge gets the history's columns and none of its rows.
    """
    if checkpoint and not stream_id:
        stream_id = _stream_id(batch.sparkSession, checkpoint)
    if not stream_id:
        raise ValueError("Batches of a stream without an id could be taken for those of another")
    commit_id, source = f"batch-{stream_id}-{batch_id:012d}", f"stream:{stream_id}"
    table_log = open_log(batch.sparkSession, log_dir)
    if table_log.find(commit_id, source) is not None:
        return
    at = system_time(batch_id)
    batch = prepare(batch) if prepare else batch
    if schema_only:
        prev = None if table_log.schema is None else batch.sparkSession.createDataFrame([], table_log.schema)
        rows = merge(prev, batch, system_time=at)
    else:
        rows = merge_with_existing(
            batch,
            merge,
            data_dir=data_dir,
            log_dir=log_dir,
            system_time=at,
            event_time=event_time(batch_id) if event_time else None,
            table_log=table_log,
        )
    commit(rows, data_dir, log_dir, system_time=at, commit_id=commit_id, source=source, log=table_log)


def poll(
    stream: DataFrame,
    *,
    merge: Merge,
    data_dir: str,
    log_dir: str,
    checkpoint: str,
    system_time: Callable[[int], datetime] = now,
    event_time: Callable[[int], datetime] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Ingest a stream of raw rows; by default all that is there now, then stop."""

    def one(batch: DataFrame, batch_id: int) -> None:
        commit_batch(
            batch,
            batch_id,
            merge=merge,
            data_dir=data_dir,
            log_dir=log_dir,
            system_time=system_time,
            event_time=event_time,
            prepare=prepare,
            checkpoint=checkpoint,
        )

    return (
        stream.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
