"""The history table on disk: Parquet data, one directory per commit, and a commit log.

Data goes to ``<data_dir>/__commit=<id>`` by overwriting, and counts only once ``log_dir`` has
its record. A job that dies in between leaves a directory nobody reads, and running the same
commit again replaces it, so every commit takes effect exactly once. A table has one writer at a
time.

The log is a compacted part, ``compact/upto=<n>`` with all records up to number n as Parquet, and
a tail of one small file for each record after it, ``tail/after=<n>``. The tail begins with one row
that sums up the compacted part, so that a commit reads the tail alone: at most ``TAIL`` records reach
the driver, whatever the age of the table. Compaction runs on the executors. A record holds the
table's schema only if its commit changed it.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.functions.columns import fitted, folded, has_column, reconcile, ref, resolved, time_literal, type_of
from tablelog.functions.digest import LANES, digest_metrics, digest_of, digest_text, fields_digest, row_digest
from tablelog.vocab import DEFAULT_VOCABULARY

_RECORD = (
    "commit_id string, sequence bigint, system_time string, prev_block_hash string,"
    " hash string, num_records bigint, interval_start string, interval_end string,"
    " table_schema string, input string, min_event_time string, max_event_time string,"
    " lane0 string, lane1 string"
)
# A row of the tail: a record, or (with ``unknown_times``) what the compacted records sum up to.
_TAIL_ROW = f"{_RECORD}, unknown_times bigint"
_HASH = "__row_hash"
_COMMIT = "__commit"
_ID = re.compile(r"[A-Za-z0-9_.-]+")
#: Records in the tail of the log before it is compacted.
TAIL = 32
#: Records in one file of the compacted part.
FILE_RECORDS = 100_000


class OtherInput(ValueError):
    """A commit id is recorded already, for another input."""


@dataclass(frozen=True)
class CommitRecord:
    """What a commit added: when, how many rows, their digest, and from which input.

    ``table_schema`` is empty if the commit left the schema as it was. ``lane0`` and ``lane1`` are the
    sums behind the digest: those of several commits add up to the sums of all their rows.
    """

    commit_id: str
    sequence: int
    system_time: str
    prev_block_hash: str
    hash: str
    num_records: int
    interval_start: str
    interval_end: str
    table_schema: str
    input: str = ""
    # Oldest and newest event time of the commit's rows, "" without any; None if they are not known.
    min_event_time: str | None = None
    max_event_time: str | None = None
    lane0: str = "0"
    lane1: str = "0"


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, none if it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def _commit_dir(data_dir: str, commit_id: str) -> str:
    return f"{data_dir.rstrip('/')}/{_COMMIT}={commit_id}"


def _compacted(spark: SparkSession, log_dir: str) -> int:
    """Number of the last record in the newest whole compacted part, 0 without one."""
    done = [int(name[5:]) for name in names_in(spark, f"{log_dir}/compact") if name.startswith("upto=")]
    for upto in sorted(done, reverse=True):
        if "_SUCCESS" in names_in(spark, f"{log_dir}/compact/upto={upto}"):
            return upto
    return 0


def _log_paths(spark: SparkSession, log_dir: str) -> tuple[int, list[str]]:
    upto = _compacted(spark, log_dir)
    tail = f"{log_dir}/tail/after={upto}"
    paths = [f"{log_dir}/compact/upto={upto}"] if upto else []
    return upto, paths + ([tail] if names_in(spark, tail) else [])


def read_log(spark: SparkSession, log_dir: str) -> DataFrame | None:
    """All commit records, or None before the first commit."""
    return open_log(spark, log_dir).records()


@dataclass(frozen=True)
class TableLog:
    """A table's log: the records of its tail by commit id, and what those before it sum up to."""

    spark: SparkSession
    log_dir: str
    upto: int
    tail: dict[str, CommitRecord]
    # (last number, schema, newest event time, commits whose event times are not known)
    before: tuple[int, str, str, int] = field(default=(0, "", "", 0))

    @property
    def last(self) -> int:
        return max((r.sequence for r in self.tail.values()), default=self.before[0])

    @property
    def schema(self) -> T.StructType | None:
        held = [r for r in self.tail.values() if r.table_schema]
        text = max(held, key=lambda r: r.sequence).table_schema if held else self.before[1]
        return T.StructType.fromJson(json.loads(text)) if text else None

    def last_event_time(self) -> tuple[bool, datetime | None]:
        """Whether all commits recorded their newest event time, and the newest of all."""
        times = [r.max_event_time for r in self.tail.values()]
        if self.before[3] or any(t is None for t in times):
            return False, None
        times = [datetime.fromisoformat(t) for t in (*times, self.before[2]) if t]
        return True, max(times, default=None)

    def records(self) -> DataFrame | None:
        """All records as a table, or None before the first commit."""
        parts = []
        if self.upto:
            parts.append(self.spark.read.schema(_RECORD).parquet(f"{self.log_dir}/compact/upto={self.upto}"))
        if self.tail:
            tail = self.spark.read.schema(_TAIL_ROW).json(f"{self.log_dir}/tail/after={self.upto}")
            parts.append(tail.filter("unknown_times is null").drop("unknown_times"))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if parts else None

    def find(self, commit_id: str, source: str = "") -> CommitRecord | None:
        """The record of one commit, if there is one; it must be of the same input."""
        known = self.tail.get(commit_id)
        if known is None and self.upto:
            old = self.spark.read.schema(_RECORD).parquet(f"{self.log_dir}/compact/upto={self.upto}")
            found = old.filter(ref("commit_id") == commit_id).first()
            known = CommitRecord(**found.asDict()) if found else None
        if known is not None and source and known.input and known.input != source:
            raise OtherInput(f"Commit {commit_id} is of {known.input!r}, not of {source!r}")
        return known


def open_log(spark: SparkSession, log_dir: str) -> TableLog:
    """Read the tail of the log; what reaches the driver is at most ``TAIL`` records and one row."""
    log_dir = log_dir.rstrip("/")
    upto, paths = _log_paths(spark, log_dir)
    for path in paths:
        spark.catalog.refreshByPath(path)
    tail = f"{log_dir}/tail/after={upto}"
    rows = [r.asDict() for r in spark.read.schema(_TAIL_ROW).json(tail).collect()] if tail in paths else []
    records = {r["commit_id"]: CommitRecord(**{k: v for k, v in r.items() if k != "unknown_times"}) for r in rows if r["unknown_times"] is None}
    summed = [r for r in rows if r["unknown_times"] is not None]
    if upto and not summed:  # the job ended between compacting and summing up
        summed = [_summed(spark.read.schema(_RECORD).parquet(f"{log_dir}/compact/upto={upto}")).first().asDict()]
    before = [(r["sequence"], r["table_schema"], r["max_event_time"], r["unknown_times"]) for r in summed]
    return TableLog(spark, log_dir, upto, records, *before[:1])


def _summed(records: DataFrame) -> DataFrame:
    """One row of a tail, for all ``records``."""
    schema = F.max_by(F.when(F.col("table_schema") != "", F.col("table_schema")), F.when(F.col("table_schema") != "", F.col("sequence")))
    return records.agg(
        F.max("sequence").alias("sequence"),
        F.coalesce(schema, F.lit("")).alias("table_schema"),
        F.coalesce(F.max("max_event_time"), F.lit("")).alias("max_event_time"),
        F.count_if(F.col("max_event_time").isNull()).alias("unknown_times"),
    )


def find_commit(spark: SparkSession, log_dir: str, commit_id: str) -> CommitRecord | None:
    """The record of one commit, if there is one."""
    return open_log(spark, log_dir).find(commit_id)


def read_history(
    spark: SparkSession,
    data_dir: str,
    log_dir: str | None = None,
    log: TableLog | None = None,
    *,
    since: datetime | None = None,
    until: datetime | None = None,
    known_at: datetime | None = None,
    event_time_column: str = DEFAULT_VOCABULARY.event_time,
) -> DataFrame | None:
    """The stored rows, or None if there are none yet.

    With a log, only recorded commits are read, under the table schema the log holds, so no
    file footers are opened to find it. Without one, every Parquet file below ``data_dir``
    counts and their schemas are merged.

    ``since`` and ``until`` keep the rows with event times between them (both included),
    ``known_at`` the commits of system times up to it. The log says which commits can have such
    rows; the folders of all others are not even listed.
    """
    data_dir = data_dir.rstrip("/")
    bounds = [x for x in (since, until, known_at) if x is not None]
    if log_dir is None and log is None:
        if bounds:
            raise ValueError("Bounds need a log that says when commits are from")
        if not names_in(spark, data_dir):
            return None
        spark.catalog.refreshByPath(data_dir)
        return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(data_dir)
    log = log or open_log(spark, log_dir)
    if not log.last:
        return None
    if bounds:
        stored = read_commits(spark, data_dir, log, _within(log.records(), since, until, known_at))
        if has_column(stored, event_time_column):
            time = ref(event_time_column)
            kind = type_of(stored, resolved(stored, [event_time_column])[0])
            for bound, test in ((since, time.__ge__), (until, time.__le__)):
                if bound is not None:
                    stored = stored.filter(test(time_literal(bound, kind)))
        return stored
    spark.catalog.refreshByPath(data_dir)
    stored = spark.read.schema(log.schema.add(_COMMIT, T.StringType())).parquet(data_dir)
    # Directories of lost jobs are the exception: these few are left out by a partition filter.
    present = [x.split("=", 1)[1] for x in names_in(spark, data_dir) if x.startswith(f"{_COMMIT}=")]
    if set(present) <= set(log.tail):
        return stored.drop(_COMMIT)
    there = spark.createDataFrame([(x,) for x in present], "commit_id string")
    lost = [r["commit_id"] for r in there.join(log.records(), "commit_id", "left_anti").collect()]
    if lost:
        stored = stored.filter(~ref(_COMMIT).isin(lost))
    return stored.drop(_COMMIT)


def read_commits(spark: SparkSession, data_dir: str, log: TableLog, records: DataFrame) -> DataFrame:
    """The rows of the commits in ``records``, and of no other; only their names reach the driver."""
    data_dir = data_dir.rstrip("/")
    names = [r["commit_id"] for r in records.filter("num_records > 0").select("commit_id").collect()]
    if not names:
        return spark.createDataFrame([], log.schema)
    paths = [_commit_dir(data_dir, n) for n in sorted(names)]
    for path in paths:
        spark.catalog.refreshByPath(path)
    return spark.read.schema(log.schema).parquet(*paths)


def _within(records: DataFrame, since: datetime | None, until: datetime | None, known_at: datetime | None) -> DataFrame:
    """Commits that can have rows within the bounds; times that are not known can be any."""
    if until is not None:
        records = records.filter(F.col("min_event_time").isNull() | (F.col("min_event_time") != "") & (F.col("min_event_time") <= _iso(until)))
    if since is not None:
        records = records.filter(F.col("max_event_time").isNull() | (F.col("max_event_time") >= _iso(since)))
    if known_at is not None:
        records = records.filter(F.col("system_time") <= _iso(known_at))
    return records


def _iso(time: datetime) -> str:
    """UTC as text that orders as the times do."""
    time = time.replace(tzinfo=timezone.utc) if time.tzinfo is None else time.astimezone(timezone.utc)
    return time.isoformat()


def table_digest(spark: SparkSession, log_dir: str) -> DataFrame:
    """One row ``(hash, num_records)`` of the whole table, from the log alone.

    Equal to ``dataset_digest`` of the stored rows as long as all commits have one schema; a row's
    digest covers the columns that the table had when it was committed.
    """
    log = open_log(spark, log_dir)
    records = log.records() if log.last else spark.createDataFrame([], _RECORD)
    lanes = [F.sum(F.col(f"lane{i}").cast("decimal(38,0)")).alias(f"lane{i}") for i in range(LANES)]
    sums = records.agg(F.coalesce(F.sum("num_records"), F.lit(0)).alias("num_records"), *lanes)
    return sums.select(digest_text(F.col("num_records"), [F.col(f"lane{i}") for i in range(LANES)]).alias("hash"), "num_records")


def verify_history(spark: SparkSession, data_dir: str, log_dir: str) -> DataFrame:
    """``(commit_id, problem, recorded, stored)`` of every commit whose files are not as recorded.

    ``altered``: rows were changed, added or lost. ``lost``: no rows are left. ``foreign``: rows that no
    record speaks of, such as those of a job that died. One scan, grouped by commit; each row is
    digested under the schema that the table had at its commit.
    """
    log = open_log(spark, log_dir)
    kind = log.schema
    if kind is None:
        return spark.createDataFrame([], "commit_id string, problem string, recorded long, stored long")
    records = log.records().select(F.col("commit_id").alias(_COMMIT), "sequence", "hash", "num_records")
    # One schema for each change of it, in order.
    epochs = log.records().filter("table_schema <> ''").select("sequence", "table_schema").orderBy("sequence").collect()
    spark.catalog.refreshByPath(data_dir)
    stored = spark.read.schema(kind.add(_COMMIT, T.StringType())).parquet(data_dir)
    fold = folded(spark)
    digest = F.lit(None).cast("string")
    for e in epochs:
        fields = {
            f.name: (fitted(ref(g.name), g.dataType, f.dataType, fold), f)
            for f in T.StructType.fromJson(json.loads(e["table_schema"]))
            for g in kind
            if fold(g.name) == fold(f.name)
        }
        digest = F.when(F.col("sequence") >= e["sequence"], fields_digest(fields)).otherwise(digest)
    rows = stored.join(records.select(_COMMIT, "sequence"), _COMMIT, "left").select(_COMMIT, digest.alias(_HASH))
    found = rows.groupBy(_COMMIT).agg(*digest_metrics(ref(_HASH)))
    found = found.select(_COMMIT, F.col("num_records").alias("stored"), digest_text(F.col("num_records"), [F.col(f"lane{i}") for i in range(LANES)]).alias("found"))
    both = found.join(records, _COMMIT, "full_outer")
    problem = (
        F.when(F.col("sequence").isNull(), "foreign")
        .when((F.col("num_records") > 0) & F.col("stored").isNull(), "lost")
        .when((F.col("num_records") > 0) & (F.col("found") != F.col("hash")) | (F.col("num_records") == 0) & F.col("stored").isNotNull(), "altered")
    )
    out = both.select(ref(_COMMIT).alias("commit_id"), problem.alias("problem"), F.col("num_records").alias("recorded"), F.coalesce("stored", F.lit(0)).cast("long").alias("stored"))
    return out.filter("problem is not null")


def _micros(df: DataFrame, column: str) -> Column | None:
    """The column as microseconds since 1970 in UTC, if it holds times."""
    if column not in df.columns:
        return None
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(ref(column))
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(kind), ref(column))
    return None


def _instant(micros: int | None) -> str:
    return "" if micros is None else _iso(datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros))


def commit(
    df: DataFrame,
    data_dir: str,
    log_dir: str,
    *,
    system_time: datetime,
    commit_id: str,
    coalesce: int = 0,
    repartition: int = 0,
    source: str = "",
    event_time_column: str = DEFAULT_VOCABULARY.event_time,
    log: TableLog | None = None,
) -> CommitRecord:
    """Append ``df`` as one commit and record it; a known commit id changes nothing.

    ``source`` says what the rows are from; the same id with another source is refused. Columns
    of the table that ``df`` lacks become NULL, new ones join the table, and a type that the
    table's does not hold is refused.

    Count, digest and bounds of the event time are observed while the files are written, so the rows are
    computed once. ``coalesce`` limits the number of files, and with it the tasks that compute
    them; ``repartition`` writes that many files from all tasks, for one more exchange of ``df``.
    With neither the partitions are left alone.
    """
    if not _ID.fullmatch(commit_id):
        raise ValueError(f"Commit id {commit_id!r} is not a plain file name")
    spark, log_dir = df.sparkSession, log_dir.rstrip("/")
    log = log or open_log(spark, log_dir)
    known = log.find(commit_id, source)
    if known is not None:
        return known
    held = log.schema
    if held is not None:
        df = reconcile(spark.createDataFrame([], held), df).curr
    out = df.repartition(repartition) if repartition else df
    out = out.coalesce(coalesce) if coalesce else out
    # Observed in the writing stage itself: a task that is run again counts once.
    metrics = Observation()
    micros = _micros(out, event_time_column)
    extra = [] if micros is None else [F.min(micros).alias("oldest"), F.max(micros).alias("newest")]
    hashed = out.withColumn(_HASH, row_digest(out))
    observed = hashed.observe(metrics, *digest_metrics(F.col(_HASH)), *extra).drop(_HASH)
    observed.write.mode("overwrite").parquet(_commit_dir(data_dir, commit_id))

    instant = _iso(system_time)
    seen = metrics.get
    first, last = (None, None) if micros is None else (_instant(seen["oldest"]), _instant(seen["newest"]))
    record = CommitRecord(
        commit_id=commit_id,
        sequence=log.last + 1,
        system_time=instant,
        prev_block_hash="",
        hash=digest_of(seen),
        num_records=seen["num_records"],
        interval_start=instant,
        interval_end=instant,
        table_schema="" if held is not None and held.simpleString() == df.schema.simpleString() else df.schema.json(),
        input=source,
        min_event_time=first,
        max_event_time=last,
        **{f"lane{i}": str(int(seen[f"lane{i}"] or 0)) for i in range(LANES)},
    )
    _append(spark, record, log)
    return record


def _append(spark: SparkSession, record: CommitRecord, log: TableLog) -> None:
    """Write a record to the tail; when the tail is long, compact the log on the executors."""
    row = spark.createDataFrame([asdict(record)], _RECORD).coalesce(1)
    row.write.mode("append").json(f"{log.log_dir}/tail/after={log.upto}")
    if record.sequence - log.upto >= TAIL:
        everything = TableLog(spark, log.log_dir, log.upto, {record.commit_id: record}).records()
        spark.catalog.refreshByPath(f"{log.log_dir}/tail/after={log.upto}")
        path = f"{log.log_dir}/compact/upto={record.sequence}"
        everything.coalesce(1 + record.sequence // FILE_RECORDS).write.mode("overwrite").parquet(path)
        summed = _summed(spark.read.schema(_RECORD).parquet(path))
        summed.coalesce(1).write.mode("append").json(f"{log.log_dir}/tail/after={record.sequence}")
