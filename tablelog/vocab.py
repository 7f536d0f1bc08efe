"""Names of the columns the engine adds, and the observation codes."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Vocabulary:
    """Column names a history table uses for its bookkeeping."""

    system_time: str = "system_time"
    event_time: str = "event_time"
    observed: str = "observed"
    corrupt_record: str = "_corrupt_record"


@dataclass(frozen=True)
class Codes:
    """What a snapshot history writes into its observation column."""

    added: str = "I"
    changed: str = "U"
    removed: str = "D"


DEFAULT_VOCABULARY = Vocabulary()
DEFAULT_CODES = Codes()
