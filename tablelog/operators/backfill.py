"""Build the whole history of many snapshots in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.functions.columns import (
    comparable,
    contains_map,
    from_utc_text,
    ref,
    reject_reserved,
    resolved,
    time_literal,
    utc_text,
)
from tablelog.functions.keys import NullSafeKey
from tablelog.operators.snapshot import changed, compared_columns, snapshot_merge
from tablelog.vocab import DEFAULT_CODES, DEFAULT_VOCABULARY, Codes, Vocabulary

#: Rows of one key that are folded as an array; keys with more are merged dump by dump.
FOLD_ROWS = 10_000
#: So many keys with more go to all tasks; of others each task has its own.
_BROADCAST_KEYS = 10_000


def backfill_history(
    dumps: DataFrame,
    *,
    key: Sequence[str],
    times: Sequence[datetime],
    time_column: str = "snapshot_time",
    system_time: datetime | Column,
    compare: Sequence[str] = (),
    null_safe: bool = True,
    unique: bool = True,
    codes: Codes = DEFAULT_CODES,
    vocab: Vocabulary = DEFAULT_VOCABULARY,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """What merging the dumps one after another would have appended.

    ``times`` lists the dump times in order, and so also names dumps that are empty. The
    result equals sequential snapshot merges with the same ``compare`` and ``null_safe``, but
    reads and exchanges the data once instead of once per dump. A row of an unlisted dump
    stops the job; so does a duplicate key, unless ``unique`` is False.

    NULL-safe comparison of all columns of unique keys looks at neighbouring dumps only. In
    every other mode a dump is compared with the row that was last *emitted* for its key, so
    the rows of a key are folded in order. Keys with over ``fold_rows`` rows do not become an
    array: they, and they alone, are merged dump by dump.
    """
    if not times or any(a >= b for a, b in zip(times, times[1:])):
        raise ValueError("Dump times must be given in strictly ascending order")
    reject_reserved(dumps, [vocab.system_time, vocab.event_time, vocab.observed])
    key = resolved(dumps, key)
    if null_safe and unique and not compare:
        return _from_neighbours(dumps, key, times, time_column, system_time, codes, vocab)
    return _from_folds(dumps, key, times, time_column, system_time, compare, null_safe, unique, codes, vocab, fold_rows)


def _calendar(dumps: DataFrame, times: Sequence[datetime], kind: T.DataType) -> DataFrame:
    """One row per dump, as many as the caller listed: its number, time and neighbours."""
    around = zip(range(len(times)), [None, *times], times, [*times[1:], None])
    return dumps.sparkSession.createDataFrame(
        [(i, *(None if t is None else utc_text(t) for t in near)) for i, *near in around],
        "number int, before string, now string, after string",
    ).select("number", *[from_utc_text(F.col(n), kind).alias(n) for n in ("before", "now", "after")])


def _from_folds(dumps, key, times, time_column, system_time, compare, null_safe, unique, codes, vocab, fold_rows) -> DataFrame:
    kind = dumps.schema[time_column].dataType
    names = [c for c in dumps.columns if c != time_column]
    keys = NullSafeKey(dumps, key)
    values = [n for n in names if n not in key]
    kinds = {v: dumps.schema[v].dataType for v in values}
    compared = compared_columns(dumps, [c for c in compare if c != time_column], key, values)
    calendar = _calendar(dumps, times, kind)
    rows = dumps.select(*keys.columns, ref(time_column).alias("now"), F.struct(F.lit(True).alias("__here"), *map(ref, values)).alias("row"))
    rows = rows.join(F.broadcast(calendar.select("now", "number")), "now", "left")
    shown = F.concat(F.lit("Dumps hold unlisted times: "), F.to_json(F.struct("now", *keys.restored())))
    rows = rows.select(*keys.names, "row", F.coalesce("number", F.raise_error(shown).cast("int")).alias("number"))

    # One exchange: counts and arrays are taken per key, after exact duplicates went per task.
    plain = not any(map(contains_map, kinds.values()))
    order = [] if plain else [F.struct(*[comparable(ref(v, "row"), k).alias(v) for v, k in kinds.items()]).alias("order")]
    entry = F.struct("number", *order, "row")
    heavy = rows.groupBy(*keys.names).count().filter(F.col("count") > fold_rows).select(*keys.names).persist()
    many = heavy.count()
    if many:
        # Kept, since each of the jobs below would count the rows of all keys again.
        heavy = _kept(heavy)
        heavy = F.broadcast(heavy) if many <= _BROADCAST_KEYS else heavy.hint("shuffle_hash")
        few = rows.join(heavy, keys.names, "left_anti")
    else:
        heavy.unpersist()
        few = rows
    gather = F.collect_set if plain and not unique else F.collect_list
    entries = few.groupBy(*keys.names).agg(gather(entry).alias("entries"))
    if plain:
        entries = entries.withColumn("entries", F.array_sort("entries"))
    else:
        before = lambda a, b: F.when(a["number"] != b["number"], a["number"] - b["number"]).when(a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).otherwise(0)
        entries = entries.withColumn("entries", F.array_sort("entries", before))
    if unique:
        number = F.transform("entries", lambda e: e["number"])
        twice = F.size(F.array_distinct(number)) < F.size(number)
        shown = F.concat(F.lit("Dumps hold duplicate keys: "), F.to_json(F.struct(*keys.restored())))
        entries = entries.withColumn("entries", F.when(twice, F.raise_error(shown).cast(entries.schema["entries"].dataType)).otherwise(F.col("entries")))
    folded = F.explode(_fold(F.col("entries"), entries.schema["entries"].dataType, dumps, compared, null_safe, codes, len(times)))
    changes = entries.select(*keys.restored(), folded.alias("change"))
    changes = changes.select(*[ref(k) for k in key], F.col("change.number").alias("number"), F.col("change.code").alias("code"), F.col("change.row").alias("row"))
    changes = changes.join(F.broadcast(calendar.select("number", "now")), "number")
    out = changes.select(
        time_literal(system_time).alias(vocab.system_time),
        F.col("now").alias(vocab.event_time),
        F.col("code").alias(vocab.observed),
        *[(ref(n) if n in key else ref(n, "row")).alias(n) for n in names],
    )
    if not many:
        return out
    # The heavy keys' rows, few keys though many rows; kept, as every dump is read from them.
    rest = rows.join(heavy, keys.names, "left_semi").select("number", *keys.restored(), "row")
    rest = _kept(rest.select("number", *[(ref(n) if n in key else ref(n, "row")).alias(n) for n in names]).persist())
    if unique:
        twice = rest.groupBy("number", *map(ref, key)).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"Dumps hold duplicate keys: {twice[0].asDict()}")
    log = None
    for number, time in enumerate(times):
        dump = rest.filter(F.col("number") == number).drop("number")
        at = time_literal(time, kind)
        new = snapshot_merge(
            log, dump, key=key, system_time=system_time, event_time=at, compare=compare, null_safe=null_safe, codes=codes, vocab=vocab, last_event_time=None
        )
        # Written, so that neither the plan nor the work grows with the dumps before.
        new = _kept(new.persist())
        log = new if log is None else log.unionByName(new)
    return out.unionByName(log)


def _kept(persisted: DataFrame) -> DataFrame:
    """The rows in the checkpoint folder, worked out once; without ``persist`` a checkpoint does so twice."""
    try:
        return persisted.checkpoint()
    finally:
        persisted.unpersist()


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once; inside lambdas Spark does not share it."""
    return F.transform(F.array(value), use)[0]


def _fold(entries: Column, kind: T.ArrayType, df: DataFrame, compared, null_safe: bool, codes: Codes, dumps: int) -> Column:
    """All changes of one key as (number, code, row), from its rows in the order of dumps.

    The state is the row last emitted, NULL where the key is absent, the dump of the last row seen, and
    whether that dump has had its change.
    """
    row = next(f.dataType for f in kind.elementType if f.name == "row")
    change = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("code", T.StringType()), T.StructField("row", row)])
    none = F.lit(None).cast(row)

    def state(held: Column, last: Column, settled: Column, out: Column) -> Column:
        return F.struct(held.alias("held"), last.alias("last"), settled.alias("settled"), out.alias("out"))

    def one(number: Column, code: Column, value: Column) -> Column:
        return F.struct(number.cast("int").alias("number"), code.cast("string").alias("code"), value.alias("row")).cast(change)

    def arrive(s: Column, e: Column) -> Column:
        """The state when the dump of ``e`` begins: the key went if dumps lie between."""
        new = e["number"] != s["last"]
        gone = s["held"].isNotNull() & (e["number"] > s["last"] + 1)
        out = F.when(gone, F.array_append(s["out"], one(s["last"] + 1, F.lit(codes.removed), s["held"]))).otherwise(s["out"])
        return state(F.when(gone, none).otherwise(s["held"]), e["number"], s["settled"] & ~new, out)

    def take(s: Column, e: Column) -> Column:
        differs = s["held"].isNull() | changed(df, compared, set(), set(), null_safe, was=s["held"], now=e["row"])
        emitted = F.when(s["held"].isNull(), codes.added).otherwise(codes.changed)
        return F.when(
            ~s["settled"] & differs,
            state(e["row"], s["last"], F.lit(True), F.array_append(s["out"], one(e["number"], emitted, e["row"]))),
        ).otherwise(s)

    start = state(none, F.lit(-1), F.lit(False), F.array().cast(T.ArrayType(change)))
    step = lambda s, e: _let(arrive(s, e), lambda a: take(a, e))
    return F.aggregate(
        entries,
        start,
        step,
        lambda s: F.when(
            s["held"].isNotNull() & (s["last"] < dumps - 1), F.array_append(s["out"], one(s["last"] + 1, F.lit(codes.removed), s["held"]))
        ).otherwise(s["out"]),
    )


def _from_neighbours(dumps, key, times, time_column, system_time, codes, vocab) -> DataFrame:
    """Each dump against the one before it, with one exchange."""
    kind = dumps.schema[time_column].dataType
    names = [c for c in dumps.columns if c != time_column]
    keys = NullSafeKey(dumps, key)
    values = [n for n in names if n not in key]

    calendar = _calendar(dumps, times, kind)
    rows = dumps.select(
        *keys.columns,
        ref(time_column).alias("now"),
        F.struct(F.lit(True).alias("__here"), *map(ref, values)).alias("row"),
    ).join(F.broadcast(calendar.drop("number").withColumn("listed", F.lit(True))), "now", "left")
    shown = lambda what: F.raise_error(F.concat(F.lit(f"Dumps hold {what}: "), F.to_json(F.struct("now", *keys.restored()))))
    # Rows are compared as they are; only maps have to be turned into something comparable.
    content = F.col("row")
    if any(contains_map(f.dataType) for f in dumps.schema if f.name in values):
        content = F.struct(
            *[comparable(ref(v, "row"), dumps.schema[v].dataType).alias(v) for v in values]
        )
    # Unique keys per dump bound a window group by the number of dumps. Duplicates are neighbours in
    # it, so the window itself finds them; a row without its dump in the calendar is unlisted.
    by_key = Window.partitionBy(*keys.names).orderBy("now")
    twice = F.coalesce(F.lag("now").over(by_key) == F.col("now"), F.lit(False))
    sound = F.when(F.col("listed").isNull(), shown("unlisted times")).when(twice, shown("duplicate keys")).otherwise(F.lit("")).cast("string")
    seen = rows.select(
        *keys.names,
        "listed",
        sound.alias("sound"),
        "now",
        "after",
        "row",
        F.lag("now").over(by_key).eqNullSafe(F.col("before")).alias("stayed"),
        F.lag("now").over(by_key).isNull().alias("first"),
        F.lag(content).over(by_key).eqNullSafe(content).alias("same"),
        F.lead("now").over(by_key).eqNullSafe(F.col("after")).alias("stays"),
    )
    appears = F.when(F.col("first") | ~F.col("stayed"), codes.added).when(
        ~F.col("same"), codes.changed
    )
    vanishes = F.when(~F.col("stays"), codes.removed)
    # Used by the filter, so that it is evaluated for every row.
    changes = seen.filter("sound = ''").select(
        *keys.restored(),
        "row",
        F.explode(
            F.array(
                F.struct(F.col("now").alias("at"), appears.alias("code")),
                F.struct(F.col("after").alias("at"), vanishes.alias("code")),
            )
        ).alias("change"),
    ).filter(F.col("change.code").isNotNull())
    return changes.select(
        time_literal(system_time).alias(vocab.system_time),
        F.col("change.at").alias(vocab.event_time),
        F.col("change.code").alias(vocab.observed),
        *[(ref(n) if n in key else ref(n, "row")).alias(n) for n in names],
    )
