"""Snapshot merges: the diff, NULL rules, duplicates, drift and longer histories."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tablelog import Codes, PastEventTime, Vocabulary, check_event_time, snapshot_merge
from tablelog.functions.keys import NullSafeKey, profile_keys, salted
from tests.conftest import final_plan, ordered, rows, salted_exchanges, ts

V1 = "id int, name string, salary int"
V2 = "id int, name string, department string, salary int"
# Rooms and their seats: 5 closes, 8 is enlarged, 9 opens.
D1 = [(5, "attic", 12), (6, "cellar", 40), (8, "hall", 300)]
D2 = [(6, "cellar", 40), (8, "hall", 350), (9, "studio", 25)]
CHANGES = [("D", 5, "attic", 12), ("U", 8, "hall", 350), ("I", 9, "studio", 25)]

# Ordinary keys, and every key treated as one to split.
PLANS = [{}, {"hot_rows": 1}]


def merge(prev, curr, step, key=("id",), **options):
    return snapshot_merge(
        prev, curr, key=list(key), event_time=ts(2 * step), system_time=ts(2 * step + 1), **options
    )


def history(spark, *dumps, schema=V1, **options):
    """The log after merging the dumps in order."""
    log = None
    for step, dump in enumerate(dumps):
        df = dump if not isinstance(dump, list) else spark.createDataFrame(dump, schema)
        new = merge(log, df, step, **options)
        log = new if log is None else log.unionByName(new, allowMissingColumns=True)
    return log


def stamped(step, changes):
    return ordered([(ts(2 * step + 1), ts(2 * step), *c) for c in changes])


def test_from_empty(spark):
    out = merge(None, spark.createDataFrame(D1, V1), 0)
    assert out.columns == ["system_time", "event_time", "observed", "id", "name", "salary"]
    assert rows(out) == stamped(0, [("I", *d) for d in D1])


@pytest.mark.parametrize("plan", PLANS)
def test_no_changes(spark, plan):
    curr = spark.createDataFrame(D1, V1)
    assert rows(merge(merge(None, curr, 0), curr, 1, **plan)) == []


@pytest.mark.parametrize("plan", PLANS)
def test_all_changes(spark, plan):
    out = merge(history(spark, D1), spark.createDataFrame(D2, V1), 1, **plan)
    assert rows(out) == stamped(1, CHANGES)


@pytest.mark.parametrize("plan", PLANS)
def test_duplicates(spark, plan):
    dump = [*D2, (8, "hall", 350), (9, "studio", 28)]
    out = merge(history(spark, D1), spark.createDataFrame(dump, V1), 1, **plan)
    assert rows(out) == stamped(1, CHANGES)


@pytest.mark.parametrize("plan", PLANS)
def test_duplicate_that_differs_wins_over_one_that_does_not(spark, plan):
    dump = [*D1, (6, "cellar", 41), (6, "cellar", 44)]
    out = merge(history(spark, D1), spark.createDataFrame(dump, V1), 1, **plan)
    assert rows(out) == stamped(1, [("U", 6, "cellar", 41)])


@pytest.mark.parametrize("plan", PLANS)
def test_duplicate_between_two_unchanged_ones(spark, plan):
    """NULLs in the history hide the outer two of three duplicates, not the middle one."""
    log = history(spark, [(1, None, 5)])
    dump = [(1, "a", 5), (1, "b", 6), (1, "c", 5)]
    out = merge(log, spark.createDataFrame(dump, V1), 1, **plan)
    assert rows(out) == stamped(1, [("U", 1, "b", 6)])


@pytest.mark.parametrize("step", [0, -1])
def test_past_or_equal_event_time(spark, step):
    log = history(spark, D1)
    with pytest.raises(PastEventTime):
        merge(log, spark.createDataFrame(D1, V1), step)


def test_event_time_check(spark):
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "event_time timestamp")
    check_event_time(df(ts(1)), df(ts(2), ts(3)))
    check_event_time(df(), df(ts(0)))
    check_event_time(df(ts(1)), df())
    for late in (ts(1), ts(0)):
        with pytest.raises(PastEventTime):
            check_event_time(df(ts(0), ts(1)), df(late, ts(5)))


@pytest.mark.parametrize("plan", PLANS)
def test_empty_dump_deletes_everything_unguarded(spark, plan):
    out = merge(history(spark, D1), spark.createDataFrame([], V1), 0, **plan)
    assert rows(out) == stamped(0, [("D", *d) for d in D1])


@pytest.mark.parametrize("plan", PLANS)
def test_added_column(spark, plan):
    dump = [(6, "cellar", "down", 40), (8, "hall", "ground", 350), (9, "studio", "up", 25)]
    out = merge(history(spark, D1), spark.createDataFrame(dump, V2), 1, **plan)
    assert out.columns[-1] == "department"
    expected = [
        ("D", 5, "attic", 12, None),
        ("U", 6, "cellar", 40, "down"),
        ("U", 8, "hall", 350, "ground"),
        ("I", 9, "studio", 25, "up"),
    ]
    assert rows(out) == stamped(1, expected)


@pytest.mark.parametrize("plan", PLANS)
def test_missing_column(spark, plan):
    first = [(i, n, "north", s) for i, n, s in D1]
    log = history(spark, first, schema=V2)
    dump = [(6, "cellar", 40), (8, "hall", 300), (9, "studio", 25)]
    out = merge(log, spark.createDataFrame(dump, V1), 1, **plan)
    expected = [
        ("D", 5, "attic", "north", 12),
        ("U", 6, "cellar", None, 40),
        ("U", 8, "hall", None, 300),
        ("I", 9, "studio", None, 25),
    ]
    assert rows(out) == stamped(1, expected)


def test_column_that_returns_is_no_change(spark):
    """Its stored value is NULL, and by default NULL to value is not a change."""
    wide = spark.createDataFrame([(1, "a", "east", 1)], V2)
    narrow = spark.createDataFrame([(1, "a", 1)], V1)
    log = history(spark, wide, narrow)
    assert rows(merge(log, wide, 2)) == []
    assert rows(merge(log, wide, 2, null_safe=True), "observed", "department") == [("U", "east")]


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize(
    "null_safe, expected",
    [(False, [("U", 3, "y", 2)]), (True, [("U", 1, "v", 1), ("U", 2, None, 1), ("U", 3, "y", 2)])],
)
def test_null_rules(spark, plan, null_safe, expected):
    log = history(spark, [(1, None, 1), (2, "v", 1), (3, None, 1), (4, None, 1)])
    dump = [(1, "v", 1), (2, None, 1), (3, "y", 2), (4, None, 1)]
    out = merge(log, spark.createDataFrame(dump, V1), 1, null_safe=null_safe, **plan)
    assert rows(out) == stamped(1, expected)


@pytest.mark.parametrize("plan", PLANS)
def test_null_keys(spark, plan):
    kind = "k int, j string, v string"
    key = ("k", "j")
    log = history(
        spark, [(None, None, "a"), (1, None, "b"), (None, "x", "c")], schema=kind, key=key
    )
    same = spark.createDataFrame([(None, None, "a"), (1, None, "b"), (None, "x", "c")], kind)
    assert rows(merge(log, same, 1, key=key, **plan)) == []
    dump = [(None, None, "A"), (1, None, "b"), (0, "x", "c")]
    out = merge(log, spark.createDataFrame(dump, kind), 1, key=key, **plan)
    expected = [("U", None, None, "A"), ("D", None, "x", "c"), ("I", 0, "x", "c")]
    assert rows(out) == stamped(1, expected)


@pytest.mark.parametrize("plan", PLANS)
def test_compare_columns(spark, plan):
    dump = [(5, "loft", 12), (6, "cellar", 42), (8, "hall", 300)]
    log = history(spark, D1)
    curr = spark.createDataFrame(dump, V1)
    out = merge(log, curr, 1, compare=["salary"], **plan)
    assert rows(out) == stamped(1, [("U", 6, "cellar", 42)])
    with pytest.raises(ValueError, match="Column does not exist: wage"):
        merge(log, curr, 1, compare=["wage"])
    assert rows(merge(log, curr, 1, compare=["id"], **plan)) == []


def test_reserved_columns(spark):
    for name in ("event_time", "Observed", "system_time"):
        with pytest.raises(ValueError, match="already contains"):
            merge(None, spark.createDataFrame([(1, "x")], f"id int, {name} string"), 0)


@pytest.mark.parametrize("plan", PLANS)
def test_deleted_key_returns_as_insert(spark, plan):
    log = history(spark, D1, D2)
    out = merge(log, spark.createDataFrame([D1[0], *D2], V1), 2, **plan)
    assert rows(out) == stamped(2, [("I", 5, "attic", 12)])


def test_own_names_and_codes(spark):
    vocab = Vocabulary(system_time="seen_at", event_time="as_at", observed="op")
    options = dict(vocab=vocab, codes=Codes("+", "~", "-"))
    log = history(spark, D1, **options)
    out = merge(log, spark.createDataFrame(D2, V1), 1, **options)
    assert out.columns[:3] == ["seen_at", "as_at", "op"]
    assert rows(out, "op", "id") == ordered([("-", 5), ("~", 8), ("+", 9)])


@pytest.mark.parametrize("plan", PLANS)
def test_maps_and_nested_values(spark, plan):
    kind = "id int, m map<string,int>, s struct<a:int,b:array<int>>"
    log = history(
        spark, [(1, {"x": 1}, (1, [1])), (2, {"x": 1}, (1, [1])), (3, {"x": 1}, (1, [1]))], schema=kind
    )
    dump = [(1, {"x": 1}, (1, [1])), (2, {"x": 2}, (1, [1])), (3, {"x": 1}, (1, [2]))]
    out = merge(log, spark.createDataFrame(dump, kind), 1, **plan)
    assert rows(out, "observed", "id") == [("U", 2), ("U", 3)]


@pytest.mark.parametrize("plan", PLANS)
def test_key_only_table(spark, plan):
    log = history(spark, [(1,), (2,)], schema="id int")
    out = merge(log, spark.createDataFrame([(2,), (3,), (3,)], "id int"), 1, **plan)
    assert rows(out) == stamped(1, [("D", 1), ("I", 3)])


def test_awkward_column_names(spark):
    kind = "`a.b` int, `c``d` string"
    log = history(spark, [(1, "x"), (2, "y")], schema=kind, key=("a.b",))
    out = merge(log, spark.createDataFrame([(1, "z")], kind), 1, key=("a.b",))
    assert rows(out) == stamped(1, [("U", 1, "z"), ("D", 2, "y")])


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_hot_keys(spark, hot_rows):
    """One key holds a third of the dump, another is a third of the history."""
    first = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, -2).otherwise(F.col("id")).alias("id"),
        F.lit("n").alias("name"),
        F.col("id").cast("int").alias("salary"),
    )
    second = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
        F.lit("n").alias("name"),
        F.col("id").cast("int").alias("salary"),
    ).repartition(8)
    out = merge(merge(None, first, 0), second, 1, hot_rows=hot_rows)
    expected = [("D", -2, 0), ("I", -1, 0)] + [("I", i, i) for i in range(600, 900) if i % 3]
    assert rows(out, "observed", "id", "salary") == ordered(expected)
    # The hot key is known: unchanged, changed in one copy of many, and gone.
    log = merge(None, second, 0)
    assert rows(merge(log, second.filter("id > 0 or salary = 0"), 1, hot_rows=hot_rows)) == []
    out = merge(log, second, 1, hot_rows=hot_rows)
    assert rows(out, "observed", "id", "salary") == [("U", -1, 3)]
    out = merge(log, second.filter("id > 0"), 1, hot_rows=hot_rows)
    assert rows(out, "observed", "id", "salary") == [("D", -1, 0)]


def test_plan_shape(spark, tmp_path, large):
    """History, batch and batch keys are exchanged once each, and nothing else is."""
    path, dump = str(tmp_path / "h"), str(tmp_path / "d")
    history(spark, D1).write.parquet(path)
    spark.createDataFrame(D2, V1).write.parquet(dump)
    plan = final_plan(merge(spark.read.parquet(path), spark.read.parquet(dump), 1))
    # The history's second use reuses the first exchange.
    assert plan.count("+- Exchange hash") == 3 and plan.count("ReusedExchange") == 1
    # A full outer join would hold all rows of one key in memory.
    assert "FullOuter" not in plan and "rangepartitioning" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "__salt" not in plan
    again = str(tmp_path / "twice")
    spark.createDataFrame([*D2, *D2], V1).write.parquet(again)
    split = final_plan(merge(spark.read.parquet(path), spark.read.parquet(again), 1, hot_rows=1))
    assert salted_exchanges(split) == 2


def test_pieces_have_the_target_size(spark):
    """A key at 1/1600 of the rows is split too, and no piece is much above the target."""
    rows_ = spark.range(0, 160_000, 1, 8).select(
        F.when(F.col("id") % 1600 == 7, -1).when(F.col("id") % 3 == 0, -2).otherwise(F.col("id")).alias("k"), "id"
    )
    keys = NullSafeKey(rows_, ["k"])
    profile = profile_keys(rows_, keys, hot_rows=40)
    assert profile.rows == 160_000 and sorted(profile.hot.values())[0] == 3 and len(profile.hot) == 2
    pieces = salted(rows_.select("id", *keys.columns), keys, profile, [F.col("id")])
    sizes = {(r["__key0"], r["__salt"]): r["count"] for r in pieces.groupBy("__key0", "__salt").count().collect()}
    assert sum(k == -1 for k, _ in sizes) == 3 and max(sizes.values()) < 120
    assert all(s == 0 for k, s in sizes if k >= 0)


def test_known_event_time_saves_the_scan(spark):
    log, curr = history(spark, D1), spark.createDataFrame(D2, V1)
    for known in (ts(2), ts(3)):
        with pytest.raises(PastEventTime):
            merge(log, curr, 1, last_event_time=known)
    assert rows(merge(log, curr, 1, last_event_time=ts(1))) == stamped(1, CHANGES)
    assert rows(merge(log, curr, 1, last_event_time=None)) == stamped(1, CHANGES)


@pytest.mark.parametrize("null_safe", [False, True])
def test_maps_are_compared_by_entries(spark, null_safe):
    kind = "id int, m map<string,timestamp>, a array<map<int,int>>"
    one, two = ts(1), ts(1) + timedelta(microseconds=1)
    log = history(spark, [(1, {"a": one, "b": one}, [{1: 2, 3: 4}]), (2, {"a": one}, None), (3, None, None)], schema=kind)
    dump = [(1, {"b": one, "a": one}, [{3: 4, 1: 2}]), (2, {"a": two}, None), (3, {}, None)]
    out = merge(log, spark.createDataFrame(dump, kind), 1, null_safe=null_safe)
    assert rows(out, "observed", "id") == ([("U", 2), ("U", 3)] if null_safe else [("U", 2)])


def test_key_by_the_case_rule_of_the_session(spark):
    out = merge(history(spark, D1), spark.createDataFrame(D2, V1), 1, key=("ID",))
    assert rows(out) == stamped(1, CHANGES)
