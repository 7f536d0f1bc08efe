import random
import re
from collections import Counter

import numpy as np
import pytest

from tablelog.llm import phrases

from .conftest import ODD, WORDS, prose


def brute_counts(rows, longest):
    """rows: (lang, text). Counts of (lang, phrase tuple) and words per language."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang, low = lang or "und", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return counts, total


def brute(rows, threshold, longest=5, percent=100, top=2000):
    counts, total = brute_counts(rows, longest)
    frequent = {g: n for g, n in counts.items() if n >= threshold and len(g[1]) > 1}
    out = {}
    for (lang, w), a in frequent.items():
        inside = [b for (l, v), b in frequent.items() if l == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * b >= percent * a for b in inside):
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((" ".join(w), a, counts[lang, w[:k]], counts[lang, w[k:]], total[lang], score))
    ranked = set()
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        ranked |= {(lang, i, *x) for i, x in enumerate(found[:top], 1)}
    return ranked


def table(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    return df.selectExpr("*", "'x' as words", "'y' as phrase", "1 as n", "2 as size", "3 as doc_id")


def found(df):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("percent, top", [(100, 2000), (60, 2000), (100, 7)])
def test_against_brute_force(spark, percent, top):
    rng = random.Random(percent + top)
    few = WORDS[:5]
    rows = [(rng.choice(["en", "fr", "und", None]), prose(rng, 60, few).replace(" al", "  AL\t", 1)) for _ in range(60)]
    rows += [("en", "One  two\tTHREE four Five six. one two three four five!\nsix")] * 30
    want = brute(rows, 12, percent=percent, top=top)
    # Small blocks, buckets and holds: many summaries meet, and phrases are sent several times.
    got = phrases.collocations(table(spark, rows).repartition(5), threshold=12, contained_percent=percent, top=top, bucket_mass=700, block=900, held=50)
    assert found(got) == want
    assert any(x[2] == "one two three four five" for x in want) or top == 7


def test_odd_rows(spark):
    rows = [(None, t) for _, t in ODD] + [("en", None), ("en", ""), ("de", "..!? \n"), ("fr", "Ünï ß Ünï ß " * 9)] * 3
    counts, total = brute_counts(rows, 5)
    got = {(r["lang"], r["phrase"]): r["n"] for r in phrases.phrase_counts(table(spark, rows), threshold=3).collect()}
    want = {(g[0], " ".join(g[1])): n for g, n in counts.items() if n >= 3} | {(l, ""): n for l, n in total.items()}
    assert got == want
    assert found(phrases.collocations(table(spark, rows), threshold=3)) == brute(rows, 3)


def test_empty_table(spark):
    empty = table(spark, []).filter("false")
    assert phrases.collocations(empty).collect() == [] and phrases.phrase_counts(empty).collect() == []


def test_long_text_with_one_phrase(spark):
    """A phrase that makes a third of everything, in one text of megabytes."""
    rows = [("en", "hot phrase here " * 150_000), *(("en", f"w{i} x{i} y{i} z{i}") for i in range(5000))]
    got = {r["phrase"]: (r["a"], r["score"]) for r in phrases.collocations(table(spark, rows)).collect()}
    n = 450_000 + 20_000
    assert got["hot phrase here hot phrase"] == (149_999, 1000 * 149_999 * n // (150_000 * 149_999))


def test_scores_beyond_64_bits(spark, tmp_path, monkeypatch):
    """Counts of a huge corpus give exact scores."""
    big = 10**13
    held = [("en", 0, "", 3 * big), ("en", 1, "a", big + 1), ("en", 1, "b", big - 3), ("en", 2, "a b", big // 7)]
    df = spark.createDataFrame(held, "lang string, words int, phrase string, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a, **k: df)
    [r] = phrases.collocations(None).collect()
    assert r["score"] == 1000 * (big // 7) * 3 * big // ((big + 1) * (big - 3))


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 5000, 40_000), np.repeat(np.arange(6000, 6030), 100), rng.zipf(1.3, 20_000) % 2**32]).astype(np.uint32)
    rng.shuffle(keys)
    threshold = 100
    summary = phrases.Summary(len(keys) // threshold + 1)
    for part in np.array_split(keys, 300):
        summary.add(*np.unique(part, return_counts=True))
        summary.settle()
        assert len(summary.keys) <= summary.capacity
    assert 0 < summary.lost < threshold
    values, counts = np.unique(keys, return_counts=True)
    survivors = summary.survivors(threshold)
    assert set(values[counts >= threshold]) <= set(survivors) and len(survivors) < len(values) / 5
    exact = dict(zip(values, counts))
    assert all(n <= exact[k] <= n + summary.lost for k, n in zip(summary.keys, summary.counts))
