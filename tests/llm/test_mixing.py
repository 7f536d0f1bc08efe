import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablelog.llm import mixing
from tests.llm.conftest import ODD, prose

SIZE = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes, share=1.5, weights=(5, 2, 1), repeats=2):
    """Share, cut at the limit, and share the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, fixed = set(names), {}
    while True:
        left = share * sum(sizes.values()) - sum(fixed.values())
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if part[s] > repeats * sizes[s]}
        if not over:
            return fixed | part
        fixed |= {s: repeats * sizes[s] for s in over}
        open_ -= over


@pytest.fixture
def rows():
    rng = random.Random(3)
    sources = ["b", "a", "ä", "Z", None, "c"]
    return [(i, prose(rng, rng.randint(0, 60)), rng.choices(sources, [30, 5, 5, 3, 4, 1])[0]) for i in range(300)] + [
        (*x, "odd") for x in ODD
    ]


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_every_source_gets_its_target(documents, rows, block):
    got = mixing.mix_sources(documents(rows), block_words=block).taken().collect()
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += len(SIZE.findall(r[1] or ""))
    want = targets(size)
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, words in taken.items():
        assert abs(words - want[s]) <= 0.5


def test_slots_follow_van_der_corput(documents, rows):
    mix = mixing.mix_sources(documents(rows), block_words=16)
    slots = sorted(mix.slots.collect(), key=lambda r: r["slot"])
    assert len({r["slot"] for r in slots}) == len(slots)
    share = {r["sid"]: r["slots"] / len(slots) for r in mix.sources.collect()}
    seen = defaultdict(int)
    for i, r in enumerate(slots, 1):
        assert r["rank"] == seen[r["sid"]]  # the rank by arithmetic is the rank by order
        seen[r["sid"]] += 1
        for s, part in share.items():  # every beginning of the schedule has each source in its share
            assert abs(seen[s] - part * i) <= 8


def test_rank(spark):
    n, bits, first, size = 200, 8, 37, 90
    places = {j: int(f"{j:0{bits}b}"[::-1], 2) for j in range(first, first + size)}
    df = spark.range(first, first + size).select(F.col("id").alias("share"), F.lit(first).cast("long").alias("f"), F.lit(size).cast("long").alias("n"))
    got = df.select("share", mixing.rank_in_share("share", F.col("f"), F.col("n"), bits).alias("r")).collect()
    for r in got:
        assert r["r"] == sum(p < places[r["share"]] for p in places.values())


def test_reruns_agree(documents, rows):
    df = documents(rows)
    one = sorted(map(str, mixing.mix_sources(df).taken().collect()))
    assert one == sorted(map(str, mixing.mix_sources(df.repartition(7)).taken().collect()))


def test_mixed_documents(documents, rows):
    df = documents(rows)
    got = mixing.mixed_documents(df, block_words=16)
    assert got.columns == df.columns
    taken = {(r["doc_id"], r["size"]): r for r in mixing.mix_sources(df, block_words=16).taken().collect()}
    copies = defaultdict(int)
    for r in got.collect():
        copies[r["doc_id"], len(SIZE.findall(r["text"]))] += 1
    for key, r in taken.items():
        if key[0] != 904 and r["size"]:
            assert copies[key] == int(r["taken"] / r["size"] + 0.5)


def test_empty(documents):
    df = documents([(1, "x", "s")]).filter("false")
    assert mixing.mix_sources(df).taken().count() == 0
    assert mixing.mixed_documents(df).count() == 0


def test_no_words(documents):
    got = mixing.mix_sources(documents([(1, None, "a"), (2, " ", None)])).taken().collect()
    assert {(r["doc_id"], r["taken"], r["target"]) for r in got} == {(1, 0, 0.0), (2, 0, 0.0)}


def test_many_slots_are_neither_broadcast_nor_one_task(documents, rows, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    mix = mixing.mix_sources(documents(rows), block_words=1)
    taken = mix.taken()
    taken.collect()
    plan = taken._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    written = mix.slots.inputFiles()
    assert mix.slots.count() > 1000 and len(written) > 8
