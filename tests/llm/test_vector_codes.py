import hashlib
import math
import random

import numpy as np
import pytest

from tablelog.llm import vector_codes


def brute(rows, entries=256, rounds=4, parts=4):
    """rows: (vec_id, vector, label), unique ids. Codes, errors and codebooks in plain Python."""
    kept = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * x) for x in v], label))
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(cut[e][p]) for e in range(min(entries, len(kept)))] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = [near(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, of) if o == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    codes = {}
    for (i, _, label), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        codes[i] = ("".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label)
    flat = ",".join(str(x) for book in books for c in book for x in c)
    return codes, hashlib.sha256(flat.encode()).hexdigest()


def table(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    clashes = "code error sums v dims vector label_error label_value label_null key".split()
    return df.selectExpr("*", *(f"'x' as {c}" for c in clashes)).repartition(parts)


def vectors(n, dims=8, seed=0, spread=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(spread)]
    return [(i, [float(np.float32(x + rng.gauss(0, 0.1))) for x in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("n, dims, entries", [(400, 8, 16), (120, 4, 256), (300, 12, 40)])
def test_against_brute_force(spark, n, dims, entries):
    rows = vectors(n, dims, n)
    # Many equal vectors, and lattice points with equal distances.
    rows += [(n + i, [0.5] * dims, 7) for i in range(n // 2)]
    rows += [(2 * n + i, [float((i >> j) & 1) for j in range(dims)], None) for i in range(40)]
    want, digest = brute(rows, entries)
    got = vector_codes.compress_vectors(table(spark, rows), entries=entries)
    assert got.sha256() == digest
    labelled = vector_codes.with_label_errors(got.rows).collect()
    assert {r["vec_id"]: (bytes(r["code"]).hex(), r["error"], r["label"]) for r in labelled} == want
    sums = {}
    for _, e, label in want.values():
        sums[label] = sums.get(label, 0) + e
    assert all(r["label_error"] == sums[r["label"]] for r in labelled)


def test_labels_joined_by_shuffle(spark, monkeypatch):
    rows = vectors(60)
    many = vector_codes.compress_vectors(table(spark, rows), entries=8).rows
    want = sorted(map(tuple, vector_codes.with_label_errors(many).collect()), key=str)
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    assert sorted(map(tuple, vector_codes.with_label_errors(many).collect()), key=str) == want


def test_left_out_and_odd_rows(spark):
    rows = vectors(30)
    odd = [(100, None, 1), (101, [], 1), (102, [1.0] * 7 + [None], 1), (103, [math.nan] + [0.0] * 7, 1), (104, [math.inf] * 8, 1)]
    odd += [(105, [0.0] * 4, 1), (106, [1e30] * 8, 1), (107, [0.0] * 7, 1)]
    got = vector_codes.compress_vectors(table(spark, rows + odd), entries=8)
    want, digest = brute(rows, 8)
    assert {r["vec_id"] for r in got.rows.collect()} == set(want) and got.sha256() == digest


def test_null_and_equal_keys(spark):
    rows = vectors(20)
    rows = [*rows, *rows[:5], (None, rows[3][1], None), (None, rows[4][1], 1)]
    got = vector_codes.compress_vectors(table(spark, rows), entries=256)
    again = vector_codes.compress_vectors(table(spark, list(reversed(rows)), 1), entries=256)
    assert got.sha256() == again.sha256() and len(got.codebooks[0]) == 27
    assert sorted(map(str, got.rows.collect())) == sorted(map(str, again.rows.collect()))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, None, None)]])
def test_without_vectors(spark, rows):
    got = vector_codes.compress_vectors(table(spark, rows))
    assert vector_codes.with_label_errors(got.rows).collect() == [] and got.codebooks == []
    assert got.sha256() == hashlib.sha256(b"").hexdigest()


def test_balls_equal_a_full_search():
    rng = np.random.default_rng(3)
    for _ in range(30):
        centers = rng.integers(-20, 20, (rng.integers(1, 60), 3)).astype(float)
        if len(centers) > 4:
            centers[3] = centers[1]  # equal entries: the lower one is taken
        x = rng.integers(-25, 25, (500, 3)).astype(float)
        old = rng.integers(0, len(centers), 500)
        for a, b in zip(vector_codes.Balls(centers).nearest_from(x, old), vector_codes.nearest(x, centers)):
            assert (a == b).all()


def test_balls_skip_stable_cores(monkeypatch):
    """Parts near to their entry are never searched."""
    centers = np.array([[0.0, 0.0], [100.0, 0.0], [0.0, 100.0], [5000.0, 0.0]])
    x = np.array([[1.0, 1.0], [49.0, 0.0], [99.0, 3.0], [4990.0, 1.0]])
    searched = []
    plain = vector_codes.Balls._search
    monkeypatch.setattr(vector_codes.Balls, "_search", lambda self, x, some, c, *a: (searched.append((some.tolist(), c.tolist())), plain(self, x, some, c, *a)))
    vector_codes.Balls(centers).nearest_from(x, np.array([0, 0, 1, 3]))
    assert searched == []
    x[1] = [51.0, 0.0]
    vector_codes.Balls(centers).nearest_from(x, np.array([0, 0, 1, 3]))
    assert searched == [([1], [1, 2])]  # the far entry is no neighbour
