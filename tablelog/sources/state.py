"""The latest state of a history, stored and folded forward.

A state is the latest row of each key (removed keys as well, as their last word), with the number of
the last commit it holds: ``<state_dir>/<key>/upto=<n>/rows``. A state and the commits after n say as much
about the latest rows as the whole history, so a merge reads no older commit. Folding reads
the newest state and those commits, and writes the next state beside it; a state counts once its
mark is written, and the one before it stays for those who read it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelog.functions.columns import ref, resolved
from tablelog.operators.latest import latest_rows
from tablelog.sources.history import TableLog, names_in, open_log, read_commits
from tablelog.vocab import DEFAULT_VOCABULARY, Vocabulary

#: States of one key that are kept.
KEPT = 2


@dataclass(frozen=True)
class StateTable:
    """Where the latest states of a history are, for one key."""

    state_dir: str
    key: tuple[str, ...]
    vocab: Vocabulary = DEFAULT_VOCABULARY

    @property
    def path(self) -> str:
        """States by other keys or columns never meet."""
        v = self.vocab
        what = json.dumps([self.key, v.event_time, v.system_time, v.observed])
        return f"{self.state_dir.rstrip('/')}/{hashlib.sha256(what.encode()).hexdigest()[:16]}"

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the whole states, newest first."""
        found = [int(n[5:]) for n in names_in(spark, self.path) if n.startswith("upto=")]
        return [n for n in sorted(found, reverse=True) if "_SUCCESS" in names_in(spark, f"{self._at(n)}/mark")]

    def _at(self, upto: int) -> str:
        return f"{self.path}/upto={upto:012d}"

    def newest(self, spark: SparkSession, log: TableLog) -> int:
        """The last commit in the newest state that this log knows of, 0 without one."""
        return next((n for n in self.versions(spark) if n <= log.last), 0)

    def series(self, spark: SparkSession, data_dir: str, log: TableLog) -> DataFrame | None:
        """Rows whose latest ones are those of the whole history: the state and later commits."""
        if not log.last:
            return None
        upto = self.newest(spark, log)
        later = read_commits(spark, data_dir, log, log.records().filter(F.col("sequence") > upto))
        if not upto:
            return later
        path = f"{self._at(upto)}/rows"
        spark.catalog.refreshByPath(path)
        return spark.read.schema(log.schema).parquet(path).unionByName(later)

    def fold(self, spark: SparkSession, data_dir: str, log: TableLog) -> int:
        """Write the state as of the last commit, if it is not there; the number of that commit."""
        upto = self.newest(spark, log)
        if not log.last or upto == log.last:
            return upto
        v, series = self.vocab, self.series(spark, data_dir, log)
        key = resolved(series, self.key)
        rest = [c for c in series.columns if c not in key]
        rows = latest_rows(series, key, rest, v.event_time, [v.system_time])
        rows = rows.select(*[(ref(c) if c in key else ref(c, "row")).alias(c) for c in series.columns])
        path = self._at(log.last)
        rows.write.mode("overwrite").parquet(f"{path}/rows")
        spark.range(1).coalesce(1).write.mode("overwrite").json(f"{path}/mark")
        for old in self.versions(spark)[KEPT:]:
            where = spark._jvm.org.apache.hadoop.fs.Path(self._at(old))
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        return log.last


def read_latest(
    spark: SparkSession,
    data_dir: str,
    log_dir: str,
    state_dir: str,
    *,
    key: Sequence[str],
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    log: TableLog | None = None,
) -> DataFrame | None:
    """A short series for ``as_of`` (at its latest) and ``snapshot_merge``, in place of the history."""
    return StateTable(state_dir, tuple(key), vocab).series(spark, data_dir, log or open_log(spark, log_dir))


def fold_state(
    spark: SparkSession,
    data_dir: str,
    log_dir: str,
    state_dir: str,
    *,
    key: Sequence[str],
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    log: TableLog | None = None,
) -> int:
    """Bring the stored state up to the last commit; the number of that commit."""
    return StateTable(state_dir, tuple(key), vocab).fold(spark, data_dir, log or open_log(spark, log_dir))
