"""Properties over random histories, and the one-pass backfill against step-by-step merges."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablelog import as_of, backfill_history, dataset_digest, ledger_merge, snapshot_merge
from tests.conftest import final_plan, ordered, rows, ts

KIND = "k int, a int, b string"
ROW = st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from([None, "", "x"]))
DUMP = st.dictionaries(st.one_of(st.none(), st.integers(0, 3)), ROW, max_size=4)
SLOW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def as_rows(dump):
    return [(k, *v) for k, v in dump.items()]


def model(dumps, null_safe):
    """The log as plain Python: compare each dump with the last logged row per key."""
    log, state = [], {}
    for step, dump in enumerate(dumps):
        for k in {**state, **dump}:
            if k not in dump:
                log.append((step, "D", k, *state.pop(k)))
            elif k not in state:
                log.append((step, "I", k, *dump[k]))
                state[k] = dump[k]
            else:
                pairs = list(zip(state[k], dump[k]))
                if null_safe:
                    differs = any(p != c for p, c in pairs)
                else:
                    differs = any(p is not None and c is not None and p != c for p, c in pairs)
                if differs:
                    log.append((step, "U", k, *dump[k]))
                    state[k] = dump[k]
    return log


def sequential(spark, dumps, **options):
    log = None
    for step, dump in enumerate(dumps):
        curr = spark.createDataFrame(as_rows(dump), KIND)
        new = snapshot_merge(
            log, curr, key=["k"], system_time=ts(100), event_time=ts(step), **options
        )
        # Materialised, so that plans do not grow with the number of dumps.
        new = spark.createDataFrame(new.collect(), new.schema)
        log = new if log is None else log.union(new)
    return log


@SLOW
@given(dumps=st.lists(DUMP, min_size=1, max_size=4), null_safe=st.booleans(), hot=st.booleans())
def test_snapshots_match_model(spark, dumps, null_safe, hot):
    log = sequential(spark, dumps, null_safe=null_safe, hot_rows=1 if hot else 10**6)
    expected = ordered([(ts(s), o, *r) for s, o, *r in model(dumps, null_safe)])
    assert rows(log, "event_time", "observed", "k", "a", "b") == expected
    if null_safe:
        for step, dump in enumerate(dumps):
            state = as_of(log, ["k"], at=ts(step))
            assert rows(state, "k", "a", "b") == ordered(as_rows(dump))


@SLOW
@given(dumps=st.lists(DUMP, min_size=1, max_size=5))
def test_backfill_matches_model(spark, dumps):
    data = [(ts(step), *r) for step, dump in enumerate(dumps) for r in as_rows(dump)]
    out = backfill_history(
        spark.createDataFrame(data, "snapshot_time timestamp, " + KIND),
        key=["k"],
        times=[ts(i) for i in range(len(dumps))],
        system_time=ts(100),
    )
    assert out.columns == ["system_time", "event_time", "observed", "k", "a", "b"]
    expected = ordered([(ts(s), o, *r) for s, o, *r in model(dumps, True)])
    assert rows(out, "event_time", "observed", "k", "a", "b") == expected


KEYED = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from([None, "", "x"])), max_size=8)


@SLOW
@given(
    first=KEYED,
    second=KEYED,
    plan=st.sampled_from([{}, {"broadcast_bytes": 0}]),
)
def test_ledger_matches_model(spark, first, second, plan):
    kind = "k int, j string"
    prev = spark.createDataFrame([(ts(0), *r) for r in first], "system_time timestamp, " + kind)
    curr = spark.createDataFrame(second, kind)
    for key, of in ((["k"], lambda r: r[0]), (["j", "k"], lambda r: r)):
        out = ledger_merge(prev, curr, key=key, system_time=ts(1), **plan)
        seen = {of(r) for r in first}
        assert rows(out, "k", "j") == ordered([r for r in second if of(r) not in seen])


@SLOW
@given(data=KEYED, parts=st.integers(1, 5))
def test_digest_ignores_order(spark, data, parts):
    df = spark.createDataFrame(data, "k int, j string")
    again = spark.createDataFrame(data[::-1], "k int, j string").repartition(parts)
    assert dataset_digest(df).first() == dataset_digest(again).first()
    if data:
        fewer = spark.createDataFrame(data[1:], "k int, j string")
        assert dataset_digest(df).first() != dataset_digest(fewer).first()


def test_backfill_refuses(spark):
    kind = "snapshot_time timestamp, " + KIND
    options = dict(key=["k"], times=[ts(0), ts(1)], system_time=ts(9))
    twice = spark.createDataFrame([(ts(0), 1, 1, "x"), (ts(0), 1, 1, "x")], kind)
    with pytest.raises(PySparkException, match="duplicate keys"):
        backfill_history(twice, **options).collect()
    unlisted = spark.createDataFrame([(ts(5), 1, 1, "x")], kind)
    with pytest.raises(PySparkException, match="unlisted"):
        backfill_history(unlisted, **options).select("observed").collect()
    with pytest.raises(ValueError, match="ascending"):
        backfill_history(unlisted, **{**options, "times": [ts(1), ts(0)]})


def test_backfill_maps(spark):
    df = spark.createDataFrame(
        [(ts(0), 1, {"a": 1}), (ts(1), 1, {"a": 1}), (ts(2), 1, {"a": 2})],
        "snapshot_time timestamp, k int, m map<string,int>",
    )
    out = backfill_history(df, key=["k"], times=[ts(0), ts(1), ts(2)], system_time=ts(9))
    assert rows(out, "event_time", "observed") == ordered([(ts(0), "I"), (ts(2), "U")])


def test_backfill_exchanges_once(spark, large, tmp_path):
    path = str(tmp_path / "dumps")
    spark.createDataFrame([(ts(0), 1, 1, "x"), (ts(1), 1, 1, "y")], "snapshot_time timestamp, " + KIND).write.parquet(path)
    out = backfill_history(spark.read.parquet(path), key=["k"], times=[ts(0), ts(1)], system_time=ts(9))
    assert final_plan(out).count("Exchange hashpartitioning") == 1


def test_digest_ignores_the_order_of_map_entries(spark):
    one, two = (
        spark.createDataFrame([(1, m, [m])], "k int, m map<string,int>, a array<map<string,int>>")
        for m in ({"a": 1, "b": 2}, {"b": 2, "a": 1})
    )
    other = spark.createDataFrame([(1, {"a": 1, "b": 3}, [{"a": 1, "b": 2}])], one.schema)
    assert dataset_digest(one).first() == dataset_digest(two).first() != dataset_digest(other).first()


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), ROW), max_size=6)


def emitted(dumps, null_safe, compare=(0, 1)):
    """As ``model``, for dumps with duplicate keys: the least row that differs from the last logged one."""
    log, state = [], {}
    least = lambda r: [(v is not None, v if v is not None else 0) for v in r]
    for step, dump in enumerate(dumps):
        by_key = {}
        for k, r in dump:
            by_key.setdefault(k, []).append(r)
        for k in {**state, **by_key}:
            if k not in by_key:
                log.append((step, "D", k, *state.pop(k)))
                continue
            held = state.get(k)
            differs = lambda r: held is None or any(
                held[i] != r[i] if null_safe else held[i] is not None and r[i] is not None and held[i] != r[i] for i in compare
            )
            found = sorted(filter(differs, by_key[k]), key=least)
            if found:
                log.append((step, "I" if held is None else "U", k, *found[0]))
                state[k] = found[0]
    return log


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    dumps=st.lists(ROWS, min_size=1, max_size=5),
    null_safe=st.booleans(),
    compare=st.sampled_from([(), ("a",), ("b",)]),
    fold_rows=st.sampled_from([10_000, 3]),
)
def test_backfill_in_every_mode(spark, tmp_path_factory, dumps, null_safe, compare, fold_rows):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    data = [(ts(step), k, *r) for step, dump in enumerate(dumps) for k, r in dump]
    out = backfill_history(
        spark.createDataFrame(data, "snapshot_time timestamp, " + KIND),
        key=["k"],
        times=[ts(i) for i in range(len(dumps))],
        system_time=ts(100),
        null_safe=null_safe,
        compare=compare,
        unique=False,
        fold_rows=fold_rows,
    )
    expected = emitted(dumps, null_safe, [("a", "b").index(c) for c in compare] or (0, 1))
    assert rows(out, "event_time", "observed", "k", "a", "b") == ordered([(ts(s), *r) for s, *r in expected])


@SLOW
@given(dumps=st.lists(ROWS, min_size=1, max_size=4), compare=st.sampled_from([(), ("b",)]))
def test_backfill_equals_merges_in_default_mode(spark, dumps, compare):
    log = None
    for step, dump in enumerate(dumps):
        new = snapshot_merge(
            log, spark.createDataFrame([(k, *r) for k, r in dump], KIND), key=["k"], system_time=ts(100), event_time=ts(step), compare=compare
        )
        new = spark.createDataFrame(new.collect(), new.schema)
        log = new if log is None else log.union(new)
    data = [(ts(step), k, *r) for step, dump in enumerate(dumps) for k, r in dump]
    df = spark.createDataFrame(data, "snapshot_time timestamp, " + KIND)
    times = [ts(i) for i in range(len(dumps))]
    out = backfill_history(df, key=["k"], times=times, system_time=ts(100), null_safe=False, unique=False, compare=compare)
    assert out.columns == log.columns and rows(out) == rows(log)


def test_folded_backfill_refuses_and_takes_maps(spark, large, tmp_path):
    kind = "snapshot_time timestamp, k int, m map<string,int>"
    options = dict(key=["k"], times=[ts(0), ts(1), ts(2)], system_time=ts(9), null_safe=False)
    data = [(ts(0), 1, {"a": 1, "b": 2}), (ts(1), 1, None), (ts(2), 1, {"b": 2, "a": 1}), (ts(0), 2, None), (ts(2), 2, {"a": 3})]
    out = backfill_history(spark.createDataFrame(data, kind), **options)
    assert rows(out, "event_time", "observed", "k") == ordered([(ts(0), "I", 1), (ts(0), "I", 2), (ts(1), "D", 2), (ts(2), "I", 2)])
    with pytest.raises(PySparkException, match="duplicate keys"):
        backfill_history(spark.createDataFrame([data[0], data[0]], kind), **options).collect()
    with pytest.raises(PySparkException, match="unlisted"):
        backfill_history(spark.createDataFrame([(ts(5), 1, None)], kind), **options).collect()
    path = str(tmp_path / "dumps")
    spark.createDataFrame(data, kind).write.parquet(path)
    assert final_plan(backfill_history(spark.read.parquet(path), **options)).count("Exchange hashpartitioning") == 1


def test_backfill_with_heavy_keys_reads_the_dumps_three_times(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    data = [(ts(t), k, t * k % 7) for t in range(4) for k in range(5)] + [(ts(3), 1, n) for n in range(20)]
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    df = spark.createDataFrame(spark.sparkContext.parallelize(data, 2).map(counted), "snapshot_time timestamp, k int, v int")
    options = dict(key=["k"], times=[ts(t) for t in range(4)], system_time=ts(9), null_safe=False, unique=False)
    out = rows(backfill_history(df, **options, fold_rows=5))
    # Their number, the rows of heavy keys, and all others: however many dumps there are.
    assert read.value == 3 * len(data)
    assert out == rows(backfill_history(df, **options))
