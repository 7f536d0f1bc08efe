"""Append-only history tables on Spark: ingest, merge, and read back as of any time."""

from tablelog.functions.columns import (
    SchemaDrift,
    normalise_columns,
    reconcile,
    to_back,
    to_front,
)
from tablelog.functions.digest import dataset_digest
from tablelog.functions.wkt import wkt
from tablelog.operators.append import append_merge
from tablelog.operators.backfill import backfill_history
from tablelog.operators.guard import PastEventTime, check_event_time, event_time_bounds
from tablelog.operators.latest import as_of, one_per_key
from tablelog.operators.ledger import ledger_merge
from tablelog.operators.snapshot import snapshot_merge
from tablelog.operators.strategy import merge_strategy
from tablelog.plans.ingest import IngestTask, Source, TableOutcome, ingest, ingest_all, ingest_tables, merge_with_existing
from tablelog.plans.preprocess import SqlFunction, preprocess
from tablelog.sources.archive import archive_members, expand_archives
from tablelog.sources.geojson import parse_geojson, read_geojson
from tablelog.sources.history import CommitRecord, commit, read_history, read_log, table_digest, verify_history
from tablelog.sources.readers import CorruptRecords, corrupt_records, read_raw, reject_corrupt
from tablelog.sources.state import StateTable, fold_state, read_latest
from tablelog.streaming.ledger import poll_ledger
from tablelog.streaming.polling import poll
from tablelog.vocab import Codes, Vocabulary

__all__ = [
    "Codes",
    "CommitRecord",
    "CorruptRecords",
    "IngestTask",
    "PastEventTime",
    "SchemaDrift",
    "Source",
    "SqlFunction",
    "StateTable",
    "TableOutcome",
    "Vocabulary",
    "append_merge",
    "archive_members",
    "as_of",
    "backfill_history",
    "check_event_time",
    "commit",
    "corrupt_records",
    "dataset_digest",
    "event_time_bounds",
    "expand_archives",
    "fold_state",
    "ingest",
    "ingest_all",
    "ingest_tables",
    "ledger_merge",
    "merge_strategy",
    "merge_with_existing",
    "normalise_columns",
    "one_per_key",
    "parse_geojson",
    "poll",
    "poll_ledger",
    "preprocess",
    "read_geojson",
    "read_history",
    "read_latest",
    "read_log",
    "read_raw",
    "reconcile",
    "reject_corrupt",
    "snapshot_merge",
    "table_digest",
    "to_back",
    "to_front",
    "verify_history",
    "wkt",
]
