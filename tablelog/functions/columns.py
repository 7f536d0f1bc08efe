"""Column names, column order and schema reconciliation."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters Parquet refuses in names become "_", line breaks and tabs vanish.
_TO_UNDERSCORE = re.compile(r"[ ,;{}()=]")
_TO_NOTHING = re.compile(r"[\n\r\t]")

# Numeric types in widening order, with the decimal digits an integer type needs.
_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# The widest integer type whose every value a floating type can hold exactly.
_EXACT_IN_FLOAT = {T.FloatType: 5, T.DoubleType: 10}


class SchemaDrift(ValueError):
    """A batch column cannot be stored losslessly under its history type."""


class Reconciled(NamedTuple):
    prev: DataFrame
    curr: DataFrame
    added: set[str]
    removed: set[str]


def ref(name: str, of: str | None = None) -> Column:
    """A column by its exact name, dots and back-quotes included."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def folded(spark: SparkSession) -> Callable[[str], str]:
    """How the session compares column names."""
    if spark.conf.get("spark.sql.caseSensitive", "false") == "true":
        return str
    return str.lower


def has_column(df: DataFrame, name: str) -> bool:
    fold = folded(df.sparkSession)
    return fold(name) in {fold(c) for c in df.columns}


def to_front(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*map(ref, names), *[ref(c) for c in df.columns if c not in names])


def to_back(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[ref(c) for c in df.columns if c not in names], *map(ref, names))


def resolved(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of ``df`` that ``names`` mean by the session's rule, as ``df`` spells them."""
    fold = folded(df.sparkSession)
    known = {fold(c): c for c in df.columns}
    missing = [n for n in names if fold(n) not in known]
    if missing:
        raise ValueError("Column does not exist: " + ", ".join(missing))
    return [known[fold(n)] for n in names]


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def reject_reserved(df: DataFrame, names: Iterable[str]) -> None:
    for name in names:
        if has_column(df, name):
            raise ValueError(f"Data already contains column: {name}")


def clean_name(name: str) -> str:
    return _TO_NOTHING.sub("", _TO_UNDERSCORE.sub("_", name))


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column to a name Parquet accepts, in one projection."""
    fold = folded(df.sparkSession)
    owner: dict[str, str] = {}
    for name in df.columns:
        key = fold(clean_name(name))
        if key in owner:
            raise ValueError(f"Columns {owner[key]!r} and {name!r} both become {clean_name(name)!r}")
        owner[key] = name
    return df.toDF(*map(clean_name, df.columns))


def utc_text(value: datetime) -> str:
    """The wall clock in UTC; naive datetimes are UTC already."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value.isoformat(" ", "microseconds")


def from_utc_text(text: Column, like: T.DataType | None = None) -> Column:
    """The instant as a timestamp, or as the UTC wall clock where the column has no zone."""
    if isinstance(like, T.TimestampNTZType):
        return text.cast(like)
    instant = F.concat(text, F.lit("+00:00")).cast("timestamp")
    return instant if like is None else instant.cast(like)


def time_literal(value: datetime | Column, like: T.DataType | None = None) -> Column:
    """A timestamp constant. ``like`` keeps the history's type."""
    if isinstance(value, datetime):
        return from_utc_text(F.lit(utc_text(value)), like)
    return value if like is None else value.cast(like)


def type_of(df: DataFrame | None, name: str) -> T.DataType | None:
    if df is None or name not in df.columns:
        return None
    return df.schema[name].dataType


def _widens(source: T.DataType, target: T.DataType) -> bool:
    """Can every ``source`` value be cast to ``target`` and back unchanged?"""
    if isinstance(source, T.NullType):
        return True
    digits = _INTEGERS.get(type(source))
    if digits is not None:
        if type(target) in _INTEGERS:
            return digits <= _INTEGERS[type(target)]
        if isinstance(target, T.DecimalType):
            return digits <= target.precision - target.scale
        return digits <= _EXACT_IN_FLOAT.get(type(target), 0)
    if isinstance(source, T.FloatType):
        return isinstance(target, T.DoubleType)
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        return (
            source.scale <= target.scale
            and source.precision - source.scale <= target.precision - target.scale
        )
    return False


def _same(a: T.DataType, b: T.DataType) -> bool:
    """Equal up to nullability."""
    return a.simpleString() == b.simpleString()


def merged_type(was: T.DataType, now: T.DataType, name: str, fold: Callable[[str], str]) -> T.DataType:
    """The type that holds both: history's, with the fields that the batch adds inside.

    Structs are merged field by field, history's order first, at any depth of arrays and maps.
    What stands in both must be as wide in the history as in the batch.
    """
    if _same(was, now) or isinstance(now, T.NullType):
        return was
    if isinstance(was, T.NullType):
        return now
    if isinstance(was, T.StructType) and isinstance(now, T.StructType):
        old, new = _by_name(was, name, fold), _by_name(now, name, fold)
        fields = []
        for key in [*old, *[k for k in new if k not in old]]:
            f, g = old.get(key), new.get(key)
            kind = merged_type(f.dataType, g.dataType, f"{name}.{f.name}", fold) if f and g else (f or g).dataType
            fields.append(T.StructField((f or g).name, kind))
        return T.StructType(fields)
    if isinstance(was, T.ArrayType) and isinstance(now, T.ArrayType):
        return T.ArrayType(merged_type(was.elementType, now.elementType, f"{name}[]", fold))
    if isinstance(was, T.MapType) and isinstance(now, T.MapType):
        keys = merged_type(was.keyType, now.keyType, f"{name} (key)", fold)
        if not _same(keys, was.keyType):  # other keys would be other entries
            raise SchemaDrift(f"Map {name!r} has keys {was.keyType.simpleString()} in the history but {now.keyType.simpleString()} in the batch")
        return T.MapType(keys, merged_type(was.valueType, now.valueType, f"{name}{{}}", fold))
    if _widens(now, was):
        return was
    raise SchemaDrift(
        f"Column {name!r} is {was.simpleString()} in the history but {now.simpleString()} in the batch"
    )


def _by_name(kind: T.StructType, name: str, fold: Callable[[str], str]) -> dict[str, T.StructField]:
    found = {fold(f.name): f for f in kind}
    if len(found) < len(kind):
        raise SchemaDrift(f"Fields of {name!r} differ only in case: {kind.simpleString()}")
    return found


def fitted(column: Column, kind: T.DataType, target: T.DataType, fold: Callable[[str], str] = str.lower) -> Column:
    """``column`` of type ``kind`` as ``target``: fields by name, missing ones NULL, others left out."""
    if _same(kind, target):
        return column
    if isinstance(kind, T.StructType) and isinstance(target, T.StructType):
        own = {fold(f.name): f for f in kind}
        fields = []
        for f in target:
            g = own.get(fold(f.name))
            value = fitted(column[g.name], g.dataType, f.dataType, fold) if g else F.lit(None).cast(f.dataType)
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(column, lambda x: fitted(x, kind.elementType, target.elementType, fold))
    if isinstance(kind, T.MapType) and isinstance(target, T.MapType):
        entries = F.transform(
            F.map_entries(column),
            lambda e: F.struct(
                fitted(e["key"], kind.keyType, target.keyType, fold).alias("key"),
                fitted(e["value"], kind.valueType, target.valueType, fold).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    return column.cast(target)


def reconcile(prev: DataFrame | None, curr: DataFrame) -> Reconciled:
    """Give history and batch the same columns: history's order first, then new ones.

    A column one side lacks becomes a NULL of the other side's type, and so does a field inside
    a struct, at any depth; no column or field is ever lost, and every file of the history stays
    readable under one schema.
    """
    if prev is None:
        return Reconciled(empty_like(curr), curr, set(), set())
    fold = folded(curr.sparkSession)
    old = {fold(f.name): f for f in prev.schema}
    new = {fold(f.name): f for f in curr.schema}
    left: list[Column] = []
    right: list[Column] = []
    added: set[str] = set()
    removed: set[str] = set()
    for key in [*old, *[k for k in new if k not in old]]:
        was, now = old.get(key), new.get(key)
        if was is None:
            added.add(now.name)
            left.append(F.lit(None).cast(now.dataType).alias(now.name))
            right.append(ref(now.name))
        elif now is None:
            removed.add(was.name)
            left.append(ref(was.name))
            right.append(F.lit(None).cast(was.dataType).alias(was.name))
        else:
            kind = merged_type(was.dataType, now.dataType, was.name, fold)
            left.append(fitted(ref(was.name), was.dataType, kind, fold).alias(was.name))
            right.append(fitted(ref(now.name), now.dataType, kind, fold).alias(was.name))
    return Reconciled(prev.select(*left), curr.select(*right), added, removed)


def contains_map(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return contains_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(contains_map(f.dataType) for f in kind)
    return False


def comparable(column: Column, kind: T.DataType) -> Column:
    """The column in a form that ``=`` and ``<`` accept, NULL where it is NULL.

    A map becomes its entries in order, so that equal maps are equal however they were built;
    inside arrays and structs as well.
    """
    if not contains_map(kind):
        return column
    if isinstance(kind, T.MapType):
        parts = F.transform(
            F.map_entries(column),
            lambda e: F.struct(
                comparable(e["key"], kind.keyType).alias("key"), comparable(e["value"], kind.valueType).alias("value")
            ),
        )
        return F.array_sort(parts)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: comparable(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [comparable(column[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(column.isNotNull(), F.struct(*fields))
    return F.when(column.isNotNull(), F.to_json(column))
