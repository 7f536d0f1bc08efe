"""An order-insensitive fingerprint of a table."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.functions.columns import comparable, ref

# Fixed values of the digest format: two lanes of 15 hex digits (60 bits) per row.
LANES = 2
LANE_DIGITS = 15
_JSON = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _plain(column: Column, field: T.StructField) -> Column:
    """Times in a form that is quick to write and the same in every session time zone."""
    if isinstance(field.dataType, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(field.dataType, T.TimestampNTZType):
        column = column.cast("string")
    else:
        column = comparable(column, field.dataType)
    return column.alias(field.name)


def row_digest(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """SHA-256 of the row as JSON: names and map entries in order, NULLs written out, times in UTC."""
    return fields_digest({f.name: (ref(f.name), f) for f in df.schema if f.name not in exclude})


def fields_digest(fields: Mapping[str, tuple[Column, T.StructField]]) -> Column:
    """The same for columns of any origin, each with the field that it stands for."""
    chosen = [_plain(*fields[name]) for name in sorted(fields)]
    return F.sha2(F.to_json(F.struct(*chosen), _JSON), 256)


def digest_metrics(row_hash: Column) -> list[Column]:
    """Row count and lane sums: plain sums, so they combine per task and in any order.

    Unlike XOR, a sum does not cancel when a row appears twice.
    """
    lanes = [
        F.sum(
            F.conv(F.substring(row_hash, 1 + i * LANE_DIGITS, LANE_DIGITS), 16, 10).cast(
                "decimal(28,0)"
            )
        ).alias(f"lane{i}")
        for i in range(LANES)
    ]
    return [F.count(F.lit(1)).alias("num_records"), *lanes]


def digest_of(metrics: Mapping[str, object]) -> str:
    """The digest text from the collected metrics."""
    parts = [metrics["num_records"], *[metrics[f"lane{i}"] or 0 for i in range(LANES)]]
    return hashlib.sha256(":".join(str(int(p)) for p in parts).encode()).hexdigest()


def digest_text(count: Column, lanes: Sequence[Column]) -> Column:
    """The digest text as a column; a missing sum is that of no rows."""
    parts = [F.coalesce(x.cast("decimal(38,0)"), F.lit(0)).cast("string") for x in lanes]
    return F.sha2(F.concat_ws(":", count.cast("string"), *parts), 256)


def dataset_digest(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row ``(hash, num_records)``, independent of row order and partitioning."""
    sums = df.select(row_digest(df, exclude).alias("h")).agg(*digest_metrics(F.col("h")))
    lanes = [F.col(f"lane{i}") for i in range(LANES)]
    return sums.select(digest_text(F.col("num_records"), lanes).alias("hash"), "num_records")
