"""Reading raw files: any Spark format, with a gate against corrupt records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.functions.columns import ref
from tablelog.vocab import DEFAULT_VOCABULARY

# Formats whose parser can keep an unreadable record in a column.
_KEEPS_CORRUPT = {"csv", "json"}
# Fixed value: rows shown when corrupt records are found.
PREVIEW_ROWS = 20


class CorruptRecords(ValueError):
    """The raw data holds records that cannot be parsed."""


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: Sequence[str] | str = (),
    corrupt_column: str = DEFAULT_VOCABULARY.corrupt_record,
    strict: bool = True,
) -> DataFrame:
    """Load files of any Spark format; ``schema`` is DDL, whole or as a list of fragments.

    Parsing is always permissive and keeps bad records in ``corrupt_column``. A declared
    CSV or JSON schema without that column would turn bad fields into NULLs unnoticed, so
    ``strict`` adds it.
    """
    for one in [path] if isinstance(path, str) else path:
        spark.catalog.refreshByPath(one)
    reader = spark.read.format(fmt)
    ddl = schema if isinstance(schema, str) else ", ".join(schema)
    if ddl:
        declared = T.StructType.fromDDL(ddl)
        if strict and fmt.lower() in _KEEPS_CORRUPT and corrupt_column not in declared.names:
            declared = declared.add(corrupt_column, T.StringType())
        reader = reader.schema(declared)
    return (
        reader.options(**(options or {}))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_column)
        .load(path if isinstance(path, str) else list(path))
    )


def corrupt_records(df: DataFrame, corrupt_column: str = DEFAULT_VOCABULARY.corrupt_record) -> DataFrame:
    """The unreadable records of ``df``, with every other column.

    Whatever is selected from the result, all columns are parsed: a parser only notices bad
    values in columns it is asked for, and Spark refuses to ask for the corrupt one alone.
    """
    parsed = F.octet_length(_whole(df)) >= 0
    return df.filter(ref(corrupt_column).isNotNull() & parsed)


def _whole(df: DataFrame) -> Column:
    """The row as text; a reference to every column."""
    return F.to_json(F.struct(*map(ref, df.columns)))


def reject_corrupt(
    df: DataFrame,
    corrupt_column: str = DEFAULT_VOCABULARY.corrupt_record,
    eager: bool = True,
) -> DataFrame:
    """Fail if any record is corrupt, else drop the corrupt column.

    ``eager`` reads the data once now, stops at the first 20 bad records and shows them.
    Otherwise the check travels with the plan and stops whichever job reads a bad record,
    so clean input is parsed no extra time; use that only where all rows are read anyway.
    """
    if corrupt_column not in df.columns:
        return df
    if eager:
        show_corrupt(df, corrupt_column)
        return df.drop(corrupt_column)
    fail = F.raise_error(
        F.concat(F.lit("Corrupt records detected:\n"), F.coalesce(ref(corrupt_column), _whole(df)))
    )
    # Nothing may be filtered out before the check, so it is no pure function of the row.
    bad = ref(corrupt_column).isNotNull() & (F.spark_partition_id() >= 0)
    clean = F.when(bad, fail.cast("boolean")).otherwise(F.lit(True))
    return df.filter(clean).drop(corrupt_column)


def show_corrupt(df: DataFrame, corrupt_column: str) -> None:
    """Raise with a bounded preview if there is any corrupt record."""
    bad = corrupt_records(df, corrupt_column).limit(PREVIEW_ROWS).collect()
    if bad:
        raise CorruptRecords(
            "Corrupt records detected:\n" + "\n".join(row[corrupt_column] for row in bad)
        )
