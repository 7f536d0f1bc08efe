import random
import re

import pytest

from tablelog.llm import decontaminate
from tests.llm.conftest import ODD, WORDS, prose


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(text, items, window=10):
    own, hit, named = words(text), set(), set()
    for name, item in items:
        w = words(item)
        n = min(window, len(w))
        if not n:
            continue
        asked = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
        for p in range(len(own) - n + 1):
            if tuple(own[p : p + n]) in asked:
                hit.update(range(p, p + n))
                named.add("" if name is None else str(name))
    return len(own), hit, sorted(named)


def tables(spark, seed):
    rng = random.Random(seed)
    few = WORDS[:5]
    items = [(i, prose(rng, rng.choice([1, 2, 4, 5, 7, 9, 10, 11, 25, 40]), WORDS if i % 3 else few)) for i in range(40)]
    items += [(40, items[3][1]), (3, "Alpha, beta"), (None, "unknown item of words that has rather more than ten of them"), (41, None), (42, "..."), (43, "漢字 ünï ☃")]
    rows = []
    for i in range(150):
        parts = [prose(rng, rng.randint(0, 60), WORDS if i % 4 else few)]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1] or ""
            w = w.split()
            a = rng.randint(0, max(0, len(w) - 1))
            parts.insert(rng.randint(0, len(parts)), " ".join(w[a : a + rng.randint(1, 40)]).upper())
        rows.append((i, "\n".join(parts)))
    return rows + ODD, items


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 300), (3, 1 << 20)])
def test_spans_are_those_of_all_windows(spark, documents, seed, block):
    rows, items = tables(spark, seed)
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item", "2 as n")
    got = decontaminate.benchmark_spans(documents(rows), benchmark, block_bytes=block).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), str(n), str(sorted(hit)), str(named)) for i, t in rows for n, hit, named in [expected(t, items)])
    have = []
    for r in got:
        hit = {k for s in r["spans"] for k in range(s["from"], s["to"])}
        assert sum(s["to"] - s["from"] for s in r["spans"]) == len(hit)
        have.append((str(r["doc_id"]), str(r["n_words"]), str(sorted(hit)), str(list(r["items"]))))
    assert sorted(have) == want


def test_decontaminated(spark, documents):
    rows, items = tables(spark, 4)
    df = documents(rows)
    got = decontaminate.decontaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == df.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in got.collect()) == sorted(str(x) for x in rows if not expected(x[1], items)[1])


def test_empty(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.benchmark_spans(documents(ODD), none).collect()
    assert len(got) == len(ODD) and not any(r["spans"] or r["items"] for r in got)
    some = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert decontaminate.benchmark_spans(documents([(1, "x")]).filter("false"), some).count() == 0
