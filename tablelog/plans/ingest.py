"""From a raw file to a commit of a history table."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tablelog.functions.columns import normalise_columns
from tablelog.operators.strategy import Merge, merge_strategy
from tablelog.plans.preprocess import ENGINE, SqlFunction, Step, preprocess
from tablelog.sources.archive import archive_members
from tablelog.sources.geojson import read_geojson
from tablelog.sources.history import CommitRecord, TableLog, commit, open_log, read_history
from tablelog.sources.readers import read_raw, reject_corrupt, show_corrupt
from tablelog.sources.state import StateTable
from tablelog.vocab import DEFAULT_VOCABULARY, Vocabulary

log = logging.getLogger(__name__)

# Formats whose parsing costs more than reading the rows again from the executors.
_TEXT = {"csv", "json", "xml", "text"}


@dataclass(frozen=True)
class Source:
    """How to read a raw file and how to merge it.

    ``kind`` is ``generic`` (any Spark format named by ``format``), ``geojson``, or
    ``shapefile``: members of a bzip2-wrapped ZIP, handed to ``decoder`` if one is given.
    """

    kind: str = "generic"
    format: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: tuple[str, ...] = ()
    strict: bool = True
    lines: bool = False
    # Split large GeoJSON collections between features; see ``read_geojson``.
    split: bool = False
    sub_path_regex: str | None = None
    decoder: Callable[[DataFrame], DataFrame] | None = None
    preprocess: tuple[Step, ...] = ()
    preprocess_engine: str | None = ENGINE
    merge: str = "append"
    merge_params: Mapping[str, Any] = field(default_factory=dict)
    # Number of files written; see ``commit``.
    coalesce: int = 0
    repartition: int = 0
    # Keep the parsed file on the executors: the gate and the merge read it more than once. None: if
    # it is text to parse, or has SQL steps.
    persist: bool | None = None
    # Functions in SQL that the steps may use.
    functions: tuple[SqlFunction, ...] = ()
    # Keep steps on the executors that others read more than once.
    share_steps: bool = True
    # Called with the session of each task, to register functions or set options.
    setup: Callable[[SparkSession], None] | None = None

    def persists(self) -> bool:
        if self.persist is not None:
            return self.persist
        return self.kind != "generic" or self.format.lower() in _TEXT or bool(self.preprocess)


@dataclass(frozen=True)
class IngestTask:
    """One raw file to merge into one history table."""

    dataset_id: str
    source: Source
    data_to_ingest: str
    data_dir: str
    log_dir: str
    system_time: datetime
    event_time: datetime | None = None
    commit_id: str | None = None
    vocab: Vocabulary = DEFAULT_VOCABULARY
    # Where the latest state is stored, which snapshot merges then read in place of the history;
    # it is folded forward when so many commits came after it.
    state_dir: str | None = None
    state_commits: int = 8

    def commit_name(self) -> str:
        if self.commit_id is not None:
            return self.commit_id
        at = self.system_time
        at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
        return f"{at.strftime('%Y%m%dT%H%M%S.%fZ')}-{hashlib.sha256(self.input_name().encode()).hexdigest()[:16]}"

    def input_name(self) -> str:
        """What the commit is of: two inputs at one system time are two commits."""
        return f"{self.dataset_id}:{self.data_to_ingest}"


def _read_generic(spark: SparkSession, source: Source, path: str, vocab: Vocabulary) -> DataFrame:
    return read_raw(
        spark, path, source.format, source.options, source.schema, vocab.corrupt_record, source.strict
    )


def _read_geojson(spark: SparkSession, source: Source, path: str, vocab: Vocabulary) -> DataFrame:
    return read_geojson(spark, path, lines=source.lines, corrupt_column=vocab.corrupt_record, split=source.split)


def _read_shapefile(spark: SparkSession, source: Source, path: str, vocab: Vocabulary) -> DataFrame:
    members = archive_members(spark, path, source.sub_path_regex, bz2=True)
    return source.decoder(members) if source.decoder else members


READERS = {"generic": _read_generic, "geojson": _read_geojson, "shapefile": _read_shapefile}


def read_source(spark: SparkSession, source: Source, path: str, vocab: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    if source.kind not in READERS:
        raise NotImplementedError(f"Unsupported reader: {source.kind}")
    return READERS[source.kind](spark, source, path, vocab)


def merge_with_existing(
    curr: DataFrame,
    merge: Merge,
    *,
    data_dir: str,
    log_dir: str | None,
    system_time: datetime,
    event_time: datetime | None = None,
    table_log: TableLog | None = None,
    state: StateTable | None = None,
) -> DataFrame:
    """New rows of ``curr`` against what is stored; ``state`` stands for all commits it holds.

    A state is enough for snapshot merges by its key. Others need the whole history.
    """
    spark = curr.sparkSession
    if table_log is None and log_dir is not None:
        table_log = open_log(spark, log_dir)
    if state is not None and table_log is not None:
        prev = state.series(spark, data_dir, table_log)
    else:
        prev = read_history(spark, data_dir, log=table_log)
    known, last = table_log.last_event_time() if table_log else (False, None)
    extra = {"last_event_time": last} if known else {}
    return merge(prev, curr, system_time=system_time, event_time=event_time, **extra)


def task_session(spark: SparkSession, source: Source) -> SparkSession:
    """A session of the task's own, so that its views, functions and options end with it.

    It has the options of ``spark`` and the functions that ``source`` declares; ``source.setup`` may add more.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and own.conf.isModifiable(name):
            own.conf.set(name, value)
    if source.setup:
        source.setup(own)
    for function in source.functions:
        function.declare(own)
    return own


def ingest(spark: SparkSession, task: IngestTask) -> CommitRecord:
    """Read, check, clean, transform, merge and commit one raw file."""
    source, vocab = task.source, task.vocab
    spark = task_session(spark, source)
    table_log = open_log(spark, task.log_dir)
    known = table_log.find(task.commit_name(), task.input_name())
    if known is not None:
        log.info("Commit %s of %s is already recorded", known.commit_id, task.dataset_id)
        return known
    log.info("Ingesting %s into %s", task.data_to_ingest, task.data_dir)
    state = None
    if task.state_dir and source.merge == "snapshot":
        state = StateTable(task.state_dir, tuple(source.merge_params["key"]), vocab)
    raw = read_source(spark, source, task.data_to_ingest, vocab)
    if source.persists():
        raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    shared: list[DataFrame] = []
    try:
        # A merge reads every row, so the check can ride along; the user's SQL may skip some.
        eager = source.persists() or bool(source.preprocess)
        checked = reject_corrupt(raw, vocab.corrupt_record, eager)
        declared = source.kind == "generic" and source.schema
        named = checked if declared else normalise_columns(checked)
        batch = preprocess(named, source.preprocess, source.preprocess_engine, shared if source.share_steps else None)
        rows = merge_with_existing(
            batch,
            merge_strategy(source.merge, vocab=vocab, **source.merge_params),
            data_dir=task.data_dir,
            log_dir=task.log_dir,
            system_time=task.system_time,
            event_time=task.event_time,
            table_log=table_log,
            state=state,
        )
        record = commit(
            rows,
            task.data_dir,
            task.log_dir,
            system_time=task.system_time,
            commit_id=task.commit_name(),
            coalesce=source.coalesce,
            repartition=source.repartition,
            source=task.input_name(),
            event_time_column=vocab.event_time,
            log=table_log,
        )
    except PySparkException:
        # If corrupt records stopped the job, say so with a preview of them.
        if vocab.corrupt_record in raw.columns:
            show_corrupt(raw, vocab.corrupt_record)
        raise
    finally:
        for frame in shared:
            frame.unpersist()
        if source.persists():
            raw.unpersist()
    if state is not None and record.sequence - state.newest(spark, table_log) >= task.state_commits:
        state.fold(spark, task.data_dir, open_log(spark, task.log_dir))
    return record


def ingest_all(spark: SparkSession, tasks: Iterable[IngestTask]) -> list[CommitRecord]:
    """Run tasks in order; each sees the commits of those before it."""
    tasks = list(tasks)
    if not tasks:
        log.warning("Nothing to ingest")
    return [ingest(spark, task) for task in tasks]


@dataclass(frozen=True)
class TableOutcome:
    """What became of one table's tasks: the records of those done, the task that failed and its error,
    and those that were not tried after it."""

    data_dir: str
    records: tuple[CommitRecord, ...]
    failed: IngestTask | None = None
    error: Exception | None = None
    left: tuple[IngestTask, ...] = ()


def ingest_tables(spark: SparkSession, tasks: Iterable[IngestTask], *, at_once: int = 4) -> list[TableOutcome]:
    """Run the tasks of different tables side by side, those of one table in order.

    Up to ``at_once`` tables share the executors, each in a scheduler pool of its own, so that with
    ``spark.scheduler.mode=FAIR`` a small one does not wait for a large one. When a task fails, the
    later ones of its table are left, since they build on it; other tables go on.
    """
    by_table: dict[str, list[IngestTask]] = {}
    for task in tasks:
        by_table.setdefault(task.data_dir.rstrip("/"), []).append(task)

    def run(item: tuple[str, list[IngestTask]]) -> TableOutcome:
        data_dir, own = item
        context = spark.sparkContext
        before = context.getLocalProperty("spark.scheduler.pool")
        context.setLocalProperty("spark.scheduler.pool", data_dir)
        records: list[CommitRecord] = []
        try:
            for i, task in enumerate(own):
                try:
                    records.append(ingest(spark, task))
                except Exception as e:  # reported to the caller, table by table
                    log.error("Ingesting %s into %s failed: %s", task.data_to_ingest, data_dir, e)
                    return TableOutcome(data_dir, tuple(records), task, e, tuple(own[i + 1 :]))
            return TableOutcome(data_dir, tuple(records))
        finally:
            context.setLocalProperty("spark.scheduler.pool", before)

    with ThreadPoolExecutor(max_workers=max(1, at_once), thread_name_prefix="ingest") as workers:
        return list(workers.map(run, by_table.items()))
