import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tablelog.llm import mil_quality
from tests.llm.conftest import ODD, prose


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    rows = []
    for i in range(900):
        text = prose(rng, rng.randint(5, 150))
        if i % 4 == 0:
            bad = prose(rng, rng.randint(20, 80))
            bad = rng.choice([bad.upper(), " | ".join(bad.split()), "".join(f"{w}## " for w in bad.split())])
            text = f"{text} {bad}" if rng.random() < 0.3 else bad
        rows.append((i, text))
    return rows + ODD


@pytest.fixture
def labels(spark):
    rows = [(i, int(i % 4 != 0)) for i in range(0, 900) if i % 3] + [(5, None), (None, 1), (7, 7), (8, 0), (8, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int").selectExpr("*", "0 as text", "'x' as y")


def test_held_out_accuracy(documents, labels, rows):
    df = documents(rows)
    got = mil_quality.score(df, mil_quality.learn(df, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in held]
    assert len(held) > 120 and np.mean(right) > 0.9


def test_reruns_agree_and_names_clash(documents, labels, rows):
    df = documents(rows)
    one, two = mil_quality.learn(df, labels), mil_quality.learn(df.repartition(5), labels.repartition(3))
    assert all(np.array_equal(one.weights[k], two.weights[k]) for k in one.weights)
    got = mil_quality.score(df, one)  # the table has a column called score
    assert sorted(got.columns) == sorted(df.columns) and dict(got.dtypes)["score"] == "double"


def test_no_labels_and_one_label(spark, documents, rows):
    df = documents(rows[:20])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in mil_quality.score(df, mil_quality.learn(df, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert {r["score"] for r in mil_quality.score(df, mil_quality.learn(df, ones)).collect()} == {1.0}
    model = mil_quality.learn(df, ones)
    assert mil_quality.score(df.filter("false"), model).count() == 0


def test_every_word_is_in_a_passage():
    text = " ".join(f"w{i}" for i in range(1000))
    passages, at = mil_quality.encode(pa.array([text, None, "", "a b"]))
    size = passages[:, -2] * mil_quality.PASSAGE  # words of each passage
    assert np.diff(at).tolist() == [21, 1, 1, 1]
    assert round(size[:21].sum()) == 1000 and size[21:].round().tolist() == [0, 0, 2]


def test_gradients():
    rng = np.random.default_rng(0)
    at = np.array([0, 3, 4, 9])
    x, y = rng.standard_normal((9, 5)), np.array([1.0, 0.0, 1.0])
    shapes = {"W": (5, 4), "b": (4,), "V": (4, 3), "U": (4, 3), "w": (3,), "c": (4,), "d": (1,)}
    w = {k: rng.standard_normal(s) for k, s in shapes.items()}

    def loss(w):
        p = mil_quality._forward(w, x, at)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    got = mil_quality._gradients(w, x, at, y)
    for k in w:
        for i in np.ndindex(w[k].shape):
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k][i] += 1e-6
            down[k][i] -= 1e-6
            assert got[k][i] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-6)


def test_scores_by_brute_force(documents, labels, rows):
    """Attention over the passages of each text, one number at a time."""
    rows = rows[:60] + [(3000, prose(random.Random(1), 400))]
    df = documents(rows)
    model = mil_quality.learn(documents([r for r in rows]), labels, sample=50)
    w = {k: np.asarray(v, np.float64).tolist() for k, v in model.weights.items()}
    squash = lambda v: 1 / (1 + math.exp(-v))
    layer = lambda x, name: [sum(a * r[j] for a, r in zip(x, w[name])) for j in range(len(w[name][0]))]
    for r in mil_quality.score(df.select("doc_id", "text"), model).collect():
        bag = mil_quality.encode(pa.array([r["text"]]))[0]
        hidden, pull = [], []
        for passage in (bag - model.mean) / model.spread:
            h = [math.tanh(a + b) for a, b in zip(layer(passage.tolist(), "W"), w["b"])]
            hidden.append(h)
            gate = [math.tanh(t) * squash(u) for t, u in zip(layer(h, "V"), layer(h, "U"))]
            pull.append(math.exp(sum(a * b for a, b in zip(gate, w["w"]))))
        z = [sum(p * h[j] for p, h in zip(pull, hidden)) / sum(pull) for j in range(len(hidden[0]))]
        want = squash(sum(a * b for a, b in zip(z, w["c"])) + w["d"][0])
        assert r["score"] == pytest.approx(want, abs=1e-4)


def test_fitting_takes_one_bounded_text_of_a_key(documents, spark, monkeypatch):
    """A key on a third of the rows, and a very long text, reach the fit once and in part."""
    seen = []
    plain = mil_quality.fit
    monkeypatch.setattr(mil_quality, "fit", lambda passages, at, y, **k: (seen.append((len(passages), len(y))), plain(passages, at, y, **k))[1])
    rows = [(i, f"some words of text number {i}") for i in range(20)] + [(1, f"copy {j} of one key") for j in range(300)] + [(2, "very long " * 30_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    model = mil_quality.learn(documents(rows), labels)
    [(passages, texts)] = seen
    assert texts <= 20 and passages <= 20 + mil_quality.FITTED
    assert mil_quality.score(documents(rows), model).count() == len(rows)
