import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablelog.llm import class_lm
from tests.llm.conftest import ODD

TONGUES = [[f"{a}{b}" for b in "abcdefghijklmnopqrst"] for a in ("ka", "lo", "mi")]


def text(rng):
    words = rng.choice(TONGUES)
    rare = [f"{words[0][:2]}{rng.randrange(300)}" for _ in range(3)]
    return " ".join(rng.choices(words + rare, k=rng.randint(0, 60)))


def tokens(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), None]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    return [(i, text(rng)) for i in range(600)] + ODD + [(7000, "Never SEEN words")]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def test_base_score_and_counts(documents, rows):
    got = class_lm.class_perplexity(documents(rows), heads=40, classes=8, chunk_bytes=3000).collect()
    assert len(got) == len(rows)
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted(
        (str(i), held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6))
        for i, t in rows
    )
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r["base_score"], 6)) for r in got) == want


def test_classes_predict_held_out_text(documents, rows):
    got = class_lm.class_perplexity(documents(rows), heads=100, classes=8).filter("held_out and n_tokens > 5").collect()
    assert len(got) > 60
    assert sum(r["score"] for r in got) > 0.85 * sum(r["base_score"] for r in got)  # both are negative


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    stats = class_lm.Statistics(np.zeros(0, np.int64), np.array([3, 5, 2]), np.array([30, 50, 9]), 7)
    matrix = np.pad(rng.integers(0, 50, (4, 4)), ((0, 1), (0, 1)))
    share = 10 ** class_lm.transitions(matrix.astype(float), stats, 3)
    room = stats.tokens + 0.5 * (stats.words + 1)
    known = (stats.tokens + 0.5 * stats.words) / room  # the part of a class that is known words
    assert np.allclose((share[:, :3] * known).sum(1) + share[:, 3] + share[:, 4], 1)


def likelihood(counts, class_of, classes):
    one = np.eye(classes)[class_of]
    m = one.T @ counts @ one
    f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return f(m) - f(m.sum(0)) - f(m.sum(1))


@pytest.mark.parametrize("seed", range(5))
def test_exchange_finds_classes(seed):
    """Words of three kinds that follow each other; the likelihood never falls."""
    rng = np.random.default_rng(seed)
    seq = np.array([rng.integers(0, 10) + 10 * (i % 3) if rng.random() < 0.9 else rng.integers(0, 30) for i in range(6000)])
    counts = np.zeros((30, 30), np.float32)
    np.add.at(counts, (seq[:-1], seq[1:]), 1)
    class_of = rng.integers(0, 4, 30)
    class_of[0] = 3
    before = likelihood(counts, class_of, 4)
    for _ in range(12):
        matrix = class_lm.exchange(counts, class_of, 30, 4, 1)
        one = np.eye(4)[class_of]
        assert np.allclose(matrix[:, :4][: len(one.T)], (one.T @ counts @ one)[: len(matrix)], atol=1e-2)
        after = likelihood(counts, class_of, 4)
        assert after >= before - 1e-3
        before = after
    pure = [len(set(class_of[k : k + 10])) for k in (0, 10, 20)]
    assert sorted(pure)[:2] == [1, 1] and len(set(class_of)) >= 3


def test_reruns_agree(documents, rows):
    one, two = (
        sorted((str(r["doc_id"]), r["n_known"], round(r["score"], 9)) for r in class_lm.class_perplexity(df, heads=40, classes=8).collect())
        for df in (documents(rows), documents(rows[::-1]).repartition(5))
    )
    assert one == two


def test_chunks_do_not_matter(documents, rows):
    """All votes of a word count, whatever chunks its places fall in."""
    one, two = (
        sorted((str(r["doc_id"]), r["n_known"], round(r["score"], 6)) for r in class_lm.class_perplexity(documents(rows), heads=20, classes=8, chunk_bytes=n).collect())
        for n in (2000, 1 << 20)
    )
    assert one == two


@pytest.mark.parametrize("many", [True, False])
def test_all_votes_are_summed(many):
    """Two chunks' votes, three for class 1 and one for 2 against four for 2: the sums say 2."""
    extra = np.arange(1000, 1000 + (1 << 20) * many, dtype=np.uint64)  # words that nobody votes for
    ask = lambda words, n, *votes: (words.tobytes(), np.array(n, "<u4").tobytes(), *(np.array(x, t).tobytes() for x, t in zip(zip(*votes), ("<u4", "<u2", "<u4"))))
    rows = [(0, *ask(np.append(np.uint64(7), extra), np.append(4, np.zeros(len(extra))), (0, 1, 3), (0, 2, 1))), (1, *ask(np.array([5, 7], np.uint64), [1, 4], (0, 3, 1), (1, 2, 4)))]
    names = ["chunk", "words", "n", "owner", "vote", "times"]
    kinds = [class_lm.pa.int64(), *[class_lm.pa.binary()] * 5]
    asked = class_lm.pa.table([class_lm.pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
    got = class_lm._answers(8)((0,), asked).to_pylist()
    assert got[0]["class"][0] == 2 and list(got[1]["class"]) == [3, 2]
    assert np.frombuffer(got[1]["n"], "<i8").tolist() == [1, 8]


@pytest.mark.parametrize("heads,least", [(40, 0.85), (18, 0.9)])
def test_words_beyond_heads_find_their_classes(documents, rows, heads, least):
    """Fewer heads than the 60 frequent words: the classes of the others are learned in the rounds."""
    scores = []
    for all_rounds in (0, class_lm.ALL_ROUNDS):
        got = class_lm.class_perplexity(documents(rows), heads=heads, classes=8, all_rounds=all_rounds).filter("held_out and n_tokens > 5").collect()
        scores.append(sum(r["score"] for r in got) / sum(r["base_score"] for r in got))
    assert scores[1] < least < scores[0], scores


def test_empty_and_no_training(documents):
    assert class_lm.class_perplexity(documents([(1, "x")]).filter("false")).count() == 0
    alone = [i for i in range(50) if held(i)][:3]
    got = class_lm.class_perplexity(documents([(i, "some words") for i in alone]), heads=10, classes=4).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in got] == [(0, 0)] * 3
    assert all(math.isfinite(r["score"]) for r in got)


def test_too_many_classes_are_refused(documents):
    with pytest.raises(ValueError, match="255"):
        class_lm.class_perplexity(documents([(1, "a b")]), classes=256)
