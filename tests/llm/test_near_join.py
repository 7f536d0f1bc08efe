import random

import numpy as np
import pytest

from tablelog.llm import near_join
from tablelog.llm.components import components
from tablelog.llm.storage import Storage
from tests.llm.conftest import ODD, prose


def shingles(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def groups(sets, percent=90):
    """Smallest member of each component, by comparing all pairs."""
    names = list(sets)
    parent = {x: x for x in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {x: find(x) for x in names}


def corpus(seed, n=120, copies=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [prose(rng, rng.randint(1, 120), vocabulary) for _ in range(n)]
    passage = prose(rng, 40, vocabulary)
    texts += [f"{prose(rng, rng.randint(0, 30), vocabulary)} {passage}" for _ in range(40)]  # many share a passage
    for base in (prose(rng, 110, vocabulary), passage, prose(rng, 300, vocabulary)):
        for _ in range(copies):  # a large group of near copies, linked in chains
            words = base.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += texts[:25]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,frequent,small", [(1, 16, 32), (2, 3, 4), (3, 2, 2)])
def test_components_are_those_of_all_pairs(documents, monkeypatch, seed, frequent, small):
    monkeypatch.setattr(near_join, "SMALL", small)
    rows = corpus(seed)
    got = near_join.near_groups(documents(rows), frequent=frequent).collect()
    sets = {i: shingles(t) for i, t in rows}
    want = groups(sets)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_odd_rows(documents):
    rows = [*ODD, (10, "One  TWO"), (11, "a b c d e f"), (12, "A b\nC d e F")]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_join.near_groups(documents(rows)).collect()]
    assert len(got) == len(rows)
    assert {x for x in got if x[0] in (900, 901, 902)} == {(i, 0, i) for i in (900, 901, 902)}
    assert got.count((904, 1, 10)) == 2 and (10, 1, 10) in got
    assert {(None, 4, 11), (11, 4, 11), (12, 4, 11)} <= set(got)


def test_deduplicated(documents):
    rows = corpus(4, 60, 20) + ODD[1:]
    df = documents(rows)
    kept = near_join.deduplicated(df)
    assert kept.columns == df.columns
    want = groups({i: shingles(t) for i, t in rows})
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(got) == sorted({want[i] for i, _ in rows})


def test_empty(documents):
    df = documents([(1, "x")]).filter("false")
    assert near_join.near_groups(df).count() == 0
    assert near_join.deduplicated(df).count() == 0


@pytest.mark.parametrize("n", [9, 10, 40, 64, 100, 700])
def test_linked_sets_share_an_entry(n):
    """For sets at the border, whatever tokens are frequent."""
    rng = np.random.default_rng(n)
    for _ in range(60):
        often_of = {}
        common = rng.integers(0, 2**63, n, dtype=np.uint64)
        lost = rng.integers(0, n // 10 + 1)
        more = rng.integers(0, 2**63, max(0, min((100 * (n - lost)) // 90 - n, n)), dtype=np.uint64)
        x, y = np.unique(common), np.unique(np.concatenate([common[lost:], more]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 90 * (len(x) + len(y) - both):
            continue
        share = rng.choice([0.0, 0.5, 0.9, 1.0])
        for t in np.union1d(x, y):
            often_of[int(t)] = rng.random() < share
        entries = []
        for s in (x, y):
            one, two = near_join.prefix_entries(s, np.array([often_of[int(t)] for t in s]), 90)
            entries.append((set(one.tolist()), set(two.tolist())))
        assert entries[0][0] & entries[1][0] or entries[0][1] & entries[1][1]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 90)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    links += [(7, 7), (None, 3), (2000, 2001), (2001, 2000)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, Storage(spark, "test")).collect()}
    sets = {x for a, b in links if a is not None and a != b for x in (a, b)}
    parent = {x: x for x in sets}
    for _ in range(200):
        for a, b in links:
            if a in parent and b in parent:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


def test_tables_of_pairs_are_not_broadcast(spark):
    """Rows of a large entry take next to nothing in a file, whose size says nothing about a broadcast."""
    storage = Storage(spark, "test")
    one = spark.createDataFrame([(i, 10, 0, [5, 6]) for i in range(8)], "set long, n long, rare long, pairs array<long>")
    large = spark.createDataFrame([(5,), (6,)], "entry long")
    linked = spark.createDataFrame([(i, 0) for i in range(4)], "node long, component long")
    done = storage.table(spark.createDataFrame([(4, 5)], "a long, b long"), "done")
    rest = near_join._across(one, large, linked, done, 90, storage)
    assert "BroadcastHashJoin" not in rest._jdf.queryExecution().sparkPlan().toString()
    want = {(a, b) for a in range(8) for b in range(a + 1, 8) if b > 3} - {(4, 5)}
    assert sorted(map(tuple, rest.collect())) == sorted(want)
