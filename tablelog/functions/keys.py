"""Keys that match NULL to NULL, and a skew profile of them.

``a <=> b`` joins fine in Spark but is planned on derived expressions, so a preceding
``groupBy(key)`` cannot share its partitioning. Deriving the pair (value or default,
is it NULL) once, and both grouping and joining on that pair, lets one exchange serve both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.functions.columns import contains_map, ref

# A key with this many rows is split, into pieces of about so many.
HOT_ROWS = 1_000_000
# Keys are sketched in as many classes by hash as it takes for the heaviest of each, so many at most, to be
# all that can be heavy; and with so many counters for each row count that makes a key heavy, within limits. A
# key is certain to be reported if it has over 7 rows for each counter and class's share of the rows.
SKETCH_CLASSES = 64
SKETCH_COUNTERS = (1024, 16_384)
COUNTERS_PER_HEAVY = 16
REPORTED = 1024
# Sketches are merged in two steps, this many side by side in the first.
SKETCH_GROUPS = 256
# Largest key set, as counted, that is broadcast; below Spark's own default of 10 MB.
BROADCAST_BYTES = 8 << 20
# Memory a broadcast row takes besides its variable-length key bytes.
ROW_OVERHEAD = 64


def _default(kind: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        zero = F.lit("1970-01-01") if not isinstance(kind, T.NumericType) else F.lit(0)
        return zero.cast(kind)
    return None


class NullSafeKey:
    """The key of two reconciled tables as plain, never-NULL columns."""

    def __init__(self, df: DataFrame, key: Sequence[str]):
        if not key:
            raise ValueError("A primary key is required")
        missing = [k for k in key if k not in df.columns]
        if missing:
            raise ValueError("Column does not exist: " + ", ".join(missing))
        self.key = list(key)
        self.types = [df.schema[k].dataType for k in key]
        for name, kind in zip(self.key, self.types):
            if contains_map(kind):
                raise ValueError(f"Column {name!r} of type {kind.simpleString()} cannot be a key")
        self.names: list[str] = []
        self.columns: list[Column] = []
        self._back: list[Column] = []
        for i, (name, kind) in enumerate(zip(self.key, self.types)):
            value, absent, zero = f"__key{i}", f"__null{i}", _default(kind)
            if zero is None:
                # No simple default: a one-field struct is never NULL itself.
                self.names.append(value)
                self.columns.append(F.struct(ref(name).alias("v")).alias(value))
                self._back.append(F.col(value)["v"].alias(name))
            else:
                self.names += [value, absent]
                self.columns += [
                    F.coalesce(ref(name), zero).alias(value),
                    ref(name).isNull().alias(absent),
                ]
                self._back.append(F.when(~F.col(absent), F.col(value)).alias(name))

    def restored(self) -> list[Column]:
        """The original key columns, rebuilt from the derived ones."""
        return list(self._back)

    def hash(self) -> Column:
        return F.xxhash64(*map(F.col, self.names))

    def bytes(self) -> Column:
        size = F.lit(ROW_OVERHEAD)
        for name, kind in zip(self.key, self.types):
            if isinstance(kind, (T.StringType, T.BinaryType)):
                size = size + F.coalesce(F.octet_length(ref(name)), F.lit(0))
            elif not isinstance(kind, T.AtomicType):
                size = size + F.octet_length(F.to_json(F.struct(ref(name))))
        return size


@dataclass(frozen=True)
class KeyProfile:
    """rows: of the batch. hot: heavy keys by hash, with the number of pieces each is split into."""

    rows: int
    hot: dict[int, int]

    def table(self, spark: SparkSession) -> DataFrame:
        """``(__hot, __pieces)``: at most ``SKETCH_CLASSES * REPORTED`` rows, whatever the input."""
        return spark.createDataFrame(sorted(self.hot.items()), "__hot long, __pieces int")


def profile_keys(df: DataFrame, key: NullSafeKey, hot_rows: int = HOT_ROWS) -> KeyProfile:
    """Rows and heavy keys of a batch: a count, and for large batches a scan of the key columns.

    A batch of ``hot_rows`` rows or fewer has no heavy key. Of a larger one each task sends
    frequent-items sketches, mostly one of a few hundred kilobytes. They only steer the plan: a key
    they miss or overrate is joined correctly either way.
    """
    hashed = df.select(*key.columns).select(key.hash().alias("h"), (F.spark_partition_id() % SKETCH_GROUPS).alias("part"))
    rows = hashed.count()
    if rows <= hot_rows:
        return KeyProfile(rows, {})
    heavy = -(-rows // max(1, hot_rows))
    classes = min(SKETCH_CLASSES, -(-heavy // REPORTED))
    wanted = 1 << (COUNTERS_PER_HEAVY * heavy // classes - 1).bit_length()
    counters = min(max(wanted, SKETCH_COUNTERS[0]), SKETCH_COUNTERS[1])
    sketches = (
        hashed.groupBy("part", F.pmod(F.shiftright("h", 32), F.lit(classes)).alias("class"))
        .agg(F.expr(f"approx_top_k_accumulate(h, {counters})").alias("sketch"))
        .groupBy("class")
        .agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {counters}), {REPORTED})").alias("top"))
    )
    found = sketches.select(F.filter("top", lambda t: t["count"] >= hot_rows).alias("top")).collect()  # one row per class
    hot = {t["item"]: -(-t["count"] // hot_rows) for row in found for t in row["top"]}
    return KeyProfile(rows, {h: n for h, n in hot.items() if n > 1})


def with_pieces(df: DataFrame, key: NullSafeKey, profile: KeyProfile) -> DataFrame:
    """``df`` with ``__pieces``: 1, or of heavy keys the number of pieces."""
    hot = F.broadcast(profile.table(df.sparkSession))
    marked = df.join(hot, key.hash() == F.col("__hot"), "left").drop("__hot")
    return marked.withColumn("__pieces", F.coalesce("__pieces", F.lit(1)))


def salted(df: DataFrame, key: NullSafeKey, profile: KeyProfile, spread: Sequence[Column]) -> DataFrame:
    """Spread the rows of heavy keys over their pieces; all other rows stay in group 0.

    The salt depends on row content and input partition only, so a task that is run again
    after an executor loss sends every row to the same place.
    """
    piece = F.pmod(F.xxhash64(*spread) + F.spark_partition_id(), F.col("__pieces")).cast("int")
    return with_pieces(df, key, profile).withColumn("__salt", piece).drop("__pieces")


def replicated(df: DataFrame, key: NullSafeKey, profile: KeyProfile) -> DataFrame:
    """One copy per piece of the few rows with a heavy key (at most one row per key)."""
    every = F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1))
    return with_pieces(df, key, profile).withColumn("__salt", every).drop("__pieces")
