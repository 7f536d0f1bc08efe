import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tablelog.llm import fuzzy_lines
from tablelog.llm.storage import Storage
from tests.llm.conftest import ODD, prose


def shingles(line):
    return {line} if len(line) < 5 else {line[i : i + 5] for i in range(len(line) - 4)}


def lines_of(rows):
    """(document, place, line) of lines with a word, in the order in which the first of a group counts."""
    out = [(i, p, x) for i, t in rows for p, x in enumerate((t or "").split("\n")) if re.search("[^\x20\x09-\x0d]", x)]
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def exact_groups(lines, percent=80):
    distinct = sorted(set(lines))
    sets, parent = {x: shingles(x) for x in distinct}, {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    return {x: find(x) for x in distinct}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    vocabulary = [f"{a}{b}{c}" for a in ("ma", "te", "ri", "so") for b in ("lan", "der", "pek") for c in ("a", "on", "is", "ul")]
    base = [prose(rng, rng.randint(3, 40), vocabulary) for _ in range(60)]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randint(0, 6)):
            words = rng.choice(base).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            lines.append(" ".join(words))
        lines += [prose(rng, 12, vocabulary)] + rng.choice([[], [""], [" "], ["ok"]])
        rows.append((i, "\n".join(lines)))
    return rows + ODD[:-2] + [(906, "one two"), (907, "漢字漢字漢字\nabc"), (908, "x" * 20000)]


def test_groups_against_all_pairs(documents, rows):
    lines = lines_of(rows)
    want = exact_groups([x for _, _, x in lines])
    got = fuzzy_lines.line_groups(documents(rows)).collect()
    assert len(got) == len(want)
    at = {(i, p): x for i, p, x in lines}
    first = {}
    for i, p, x in reversed(lines):
        first[x] = (i, p)
    group = {}
    for r in got:
        line = at[r["doc_id"], r["place"]]
        assert first[line] == (r["doc_id"], r["place"])
        group.setdefault(r["group"], set()).add(line)
    # No line is joined without a reason, and nearly all links are found.
    for members in group.values():
        assert len({want[x] for x in members}) == 1
    joined, due = sum(len(x) - 1 for x in group.values()), len(want) - len(set(want.values()))
    assert joined >= 0.97 * due


def test_one_line_of_each_group_stays(documents, rows):
    got = {r["doc_id"]: r for r in fuzzy_lines.kept_lines(documents(rows)).collect()}
    groups = fuzzy_lines.line_groups(documents(rows)).collect()
    assert len(got) == len(rows)
    assert sum(len(r["kept"]) for r in got.values()) == len({r["group"] for r in groups})
    lines = lines_of(rows)
    for i, _ in rows:
        own = [p for j, p, _ in lines if j == i]
        assert got[i]["n_lines"] == len(own) and set(got[i]["kept"]) <= set(own)
    seen = set()
    for i, p, x in lines:  # a line that has not come before in any form stays
        if x not in seen and not any(len(shingles(x) & shingles(y)) > 0 for y in seen):
            assert p in got[i]["kept"]
        seen.add(x)


def test_equal_rows_and_empty(documents):
    got = fuzzy_lines.kept_lines(documents([(1, "a line of words"), (1, "a line of words"), (2, "a line of words")])).collect()
    assert sorted((r["doc_id"], r["n_lines"], len(r["kept"])) for r in got) == [(1, 1, 0), (1, 1, 1), (2, 1, 0)]
    assert fuzzy_lines.kept_lines(documents([(1, "x")]).filter("false")).count() == 0
    assert [len(r["kept"]) for r in fuzzy_lines.kept_lines(documents([(1, None), (2, "\n \n")])).collect()] == [0, 0]


def test_template_lines_make_few_pairs(documents, monkeypatch):
    """Lines that share a key with all others, though no two of them are near: pairs in proportion to lines."""
    made = {}
    plain = fuzzy_lines._across

    def counted(*args):
        out = plain(*args)
        made["pairs"] = out.count()
        return out

    monkeypatch.setattr(fuzzy_lines, "_across", counted)
    rng = random.Random(4)
    signs = "abcdefghijklmnopqrstuvwxyz0123456789"
    seen = []
    for n in (500, 2000):
        lines = ["Order number " + "".join(rng.choice(signs) for _ in range(12)) for _ in range(n)]
        got = fuzzy_lines.line_groups(documents([(i, "\n".join(lines[i::20])) for i in range(20)])).collect()
        assert len({r["group"] for r in got}) == n
        seen.append(made["pairs"])
    assert seen[1] <= max(8 * seen[0], 2000)


def test_lines_with_a_passage_in_common_make_few_pairs(documents, monkeypatch):
    """Lines of similarity 0.7, whose rarest shingles are mostly their own, are not paired for those of the passage."""
    made = []
    plain = fuzzy_lines._across

    def counted(*args):
        out = plain(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(fuzzy_lines, "_across", counted)
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghijklmnop") for _ in range(60))
    lines = [passage + "".join(rng.choice("QRSTUVWXYZ0123456789") for _ in range(12)) for _ in range(200)]
    near = [lines[0][:-1] + "!", lines[1][:-1] + "!"]
    got = fuzzy_lines.line_groups(documents([(i, "\n".join((lines + near)[i::20])) for i in range(20)])).collect()
    assert len({r["group"] for r in got}) == 200
    assert made[0] < 1000


def test_lines_with_parts_in_common_make_few_pairs(documents, monkeypatch):
    """Lines of similarity 0.64 that share even their rarest shingles, each with many others."""
    made = []
    plain = fuzzy_lines._across

    def counted(*args):
        out = plain(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(fuzzy_lines, "_across", counted)
    rng = random.Random(10)
    part = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    middle, left, right = part(50), [part(20) for _ in range(20)], [part(20) for _ in range(20)]
    lines = [x + middle + y for x in left for y in right]
    near = [lines[0][:-1] + "!", lines[1][:-1] + "!"]
    got = fuzzy_lines.line_groups(documents([(i, "\n".join((lines + near)[i::20])) for i in range(20)])).collect()
    assert len({r["group"] for r in got}) == 400
    assert made[0] < 400


def edited(rng, sizes):
    """Lines and copies of them with few or many edits."""
    lines = set()
    for n in sizes:
        x = [rng.choice("abcdefgh ") for _ in range(n)]
        for edits in (0, 1, max(1, n // 60), n // 20, n // 5):
            y = list(x)
            for _ in range(edits):
                y[rng.randrange(len(y))] = rng.choice("XYZ")
            lines.add("".join(y).strip() or "x")
    return sorted(lines)


def test_sketches_lose_no_near_pair(monkeypatch):
    """Pairs by sketches against all pairs, for sketches of different sizes and every way of comparing them."""
    rng = random.Random(12)
    lines = edited(rng, [rng.choice([6, 12, 30, 70, 300, 500, 540, 700, 1000, 1100, 2300]) + rng.randint(0, 5) for _ in range(60)])
    parsed = fuzzy_lines.Lines(pa.array(lines))
    held, n = fuzzy_lines._distinct(*parsed.shingles(slice(0, len(lines))))
    sets = [shingles(x) for x in lines]
    assert n.tolist() == [len(x) for x in sets]
    near = {(i, j) for j in range(len(lines)) for i in range(j) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    same = {(i, j) for i, j in near if rng.random() < 0.2}  # one component
    component = np.arange(len(lines))
    for i, j in sorted(same):
        component[component == component[j]] = component[i]
    rows = pa.table({"n": pa.array(n.astype(np.int32)), "component": pa.array(component), "sketch": fuzzy_lines._sketches(held, n)})
    columns = {}
    for key, own in enumerate((range(len(lines)), range(0, len(lines), 3), [5], range(20, 40))):
        own = np.array(sorted(own, key=lambda i: n[i]))
        some = rows.take(pa.array(own)).append_column("id", pa.array(own)).append_column("key", pa.array(np.full(len(own), key - 2)))
        for c in some.column_names:
            columns.setdefault(c, []).extend(some[c].to_pylist())
    types = {"n": pa.int32(), "sketch": pa.binary()}
    entries = pa.RecordBatch.from_pydict({c: pa.array(x, types.get(c, pa.int64())) for c, x in columns.items()})
    want = {(i, j) for i, j in near if component[i] != component[j]}
    for many, step in ((4, 16), (4, 10**6), (10**6, 16), (10**6, 10**6)):
        monkeypatch.setattr(fuzzy_lines, "MANY", many)
        monkeypatch.setattr(fuzzy_lines, "COMPARED_ROWS", step)
        got = set()
        for batch in fuzzy_lines._mixed_pairs(80)(iter([entries.slice(a, 50) for a in range(0, entries.num_rows, 50)])):
            got |= set(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
        assert want <= got and len(got) <= 2 * len(want)
        assert all(component[i] != component[j] for i, j in got)
    stars = entries.rename_columns([{"key": "band"}.get(c, c) for c in entries.schema.names])
    stars = stars.take(pa.array(sorted(range(stars.num_rows), key=lambda i: (columns["key"][i], columns["id"][i]))))
    monkeypatch.setattr(fuzzy_lines, "CROWD", 10**6)
    got = set()
    for batch in fuzzy_lines._stars(80)(iter([stars.slice(a, 50) for a in range(0, stars.num_rows, 50)])):
        got |= set(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
    assert {(i, j) for i, j in near if i in (0, 20)} <= got and {i for i, _ in got} <= {0, 20}


def test_group_without_a_middle_makes_few_pairs(documents, monkeypatch):
    """Copies of a line with few and many edits, of which the least is near some only: most are found to be one
    group before lines of different components are paired."""
    made = []
    plain = fuzzy_lines._across

    def counted(*args):
        out = plain(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(fuzzy_lines, "_across", counted)
    rng = random.Random(14)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)]
    lines = set()
    for _ in range(500):
        x = list(base)
        for i in rng.sample(range(300), rng.choice([2, 5, 8, 9, 9, 9])):
            x[i] = rng.choice("0123456789")
        lines.add("".join(x).strip())
    lines = sorted(lines)
    df = documents([(i, "\n".join(lines[i::10])) for i in range(10)])
    groups = []
    for crowd in (10**6, 16):
        monkeypatch.setattr(fuzzy_lines, "CROWD", crowd)
        groups.append({r["id"]: r["group"] for r in fuzzy_lines.line_groups(df).collect()})
    assert groups[0] == groups[1]
    assert made[0] > 1000 and made[1] < made[0] / 4


def test_passes_and_blocks_lose_no_link(documents, monkeypatch):
    """Keys sent in many passes and entries dealt out in blocks give the same groups; little stays on disk."""
    lines = edited(random.Random(13), [60] * 30 + [25] * 10)
    df = documents([(i, "\n".join(lines[i::10])) for i in range(10)])
    groups = []
    for share, rows, small, block in ((2, 1 << 20, 1 << 14, 64), (1, 1, 1 << 14, 64), (4, 1, 4, 3)):
        for name, value in (("PASS_SHARE", share), ("PASS_ROWS", rows), ("SMALL_ENTRY", small), ("BLOCK", block)):
            monkeypatch.setattr(fuzzy_lines, name, value)
        storage = Storage(df.sparkSession, "passes")
        groups.append({r["id"]: r["group"] for r in fuzzy_lines.line_groups(df, storage=storage).collect()})
        assert {x for x in os.listdir(storage.path.removeprefix("file:")) if "stars" not in x} == {"lines"}
    assert groups[0] == groups[1] == groups[2]
    assert len(set(groups[0].values())) < len(groups[0])


def test_large_entries_lose_no_link(documents, monkeypatch):
    """The rare shingles of large entries against all pairs, with every entry large or none."""
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefg ") for _ in range(60)) for _ in range(6)]
    lines = set()
    while len(lines) < 300:
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            x[rng.randrange(len(x))] = rng.choice("XYZ")
        lines.add("".join(x).strip())
    lines = sorted(lines)
    df = documents([(i, "\n".join(lines[i::10])) for i in range(10)])
    groups = []
    for small in (0, 10**6):
        monkeypatch.setattr(fuzzy_lines, "SMALL_ENTRY", small)
        groups.append({r["id"]: r["group"] for r in fuzzy_lines.line_groups(df).collect()})
    assert groups[0] == groups[1]


EDITS = {
    "insert": lambda rng, x, c: x[: (i := rng.randrange(len(x) + 1))] + c + x[i:],
    "substitute": lambda rng, x, c: x[: (i := rng.randrange(len(x)))] + c + x[i + 1 :],
    "prefix": lambda rng, x, c: c * rng.randint(1, max(1, len(x) // 5)) + x,
    "append": lambda rng, x, c: x + c,
}


@pytest.mark.parametrize("edit", EDITS)
@pytest.mark.parametrize("spaced", [True, False])
def test_recall_of_edits(documents, edit, spaced):
    """Every line with one edited copy of it, by brute force near enough; words or text without spaces."""
    rng = random.Random(f"{edit} {spaced}")
    signs = "abcdefghijklmnopqrstuvwxyz" + " " * 5 if spaced else [chr(0x4E00 + i) for i in range(2000)]
    pairs = []
    while len(pairs) < 400:
        x = "".join(rng.choice(signs) for _ in range(rng.choice([rng.randint(8, 30), rng.randint(30, 70), rng.randint(70, 250)]))).strip()
        y = x
        for _ in range(rng.choice([1, 1, 2, 5])):
            y = EDITS[edit](rng, y, rng.choice("QXZ"))
        a, b = shingles(x), shingles(y)
        if x != y and 10 * len(a & b) >= 8 * len(a | b):
            pairs.append((x, y))
    df = documents([(i, "\n".join(x)) for i, x in enumerate(pairs)])
    found = len(pairs) * 2 - len({r["group"] for r in fuzzy_lines.line_groups(df).collect()})
    assert found >= 0.99 * len(pairs)
