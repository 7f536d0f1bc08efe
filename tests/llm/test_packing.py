import functools
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tablelog.llm import packing
from tablelog.llm.queries import tokenizer_path

from .conftest import ODD, prose

tokenizers = pytest.importorskip("tokenizers")
FILE = tokenizer_path("word_bpe_49k.json")

TEXTS = [
    "Don't stop: it's we'll THEY'RE x's 'tis ''s !'s",
    "a<|endoftext|>b <|startoftext|> <|endof text|>",
    "tabs\tand\nlines\r\n\r\n  spaces  .. a.b,c;d (e) [f] g-h_i 12 345a6",
    "Ünïcodé ÉTÉ ß İstanbul ΣΑΣ ﬁ 漢字かな ไทย 한국어 é ≮ á. ́x   y　z ​",
    "😀👩‍👩‍👧 emoji … — “quotes” \x00\x01\x7f\x1c\x85 end",
    "x" * 5000 + " " + "é" * 3000,
    " " * 50,
]


@functools.cache
def plain_tokenizer(file=FILE):
    return tokenizers.Tokenizer.from_file(file)


def library(text):
    return plain_tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, limits=packing.Limits(), whole=True):
    """Contract of the pieces; texts: list of all documents' texts by key."""
    longest = limits.longest()
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_key[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    want = Counter()
    for key, text in texts:
        ids = library(text)
        for i, a in enumerate(range(0, len(ids), longest)):
            part = ids[a : a + longest]
            want[key, i, a, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows) == want
    tokens, documents, attention = limits.vector()
    for held in by_sequence.values():
        held.sort(key=lambda r: r["offset"])
        at = 0
        for r in held:
            assert r["offset"] == at
            at += r["length"]
        assert at <= tokens and len(held) <= documents and sum(r["length"] ** 2 for r in held) <= attention
    return len(by_sequence)


def one_by_one(lengths, limits, weights=(1.0, 0.01, 0.01), rule="norm"):
    """Best-fit of single pieces, longest first; the number of sequences."""
    whole = limits.vector().tolist()
    bins = []
    for x in sorted(lengths, reverse=True):
        need = (x, 1, x * x)
        fit = [b for b in bins if all(l >= n for l, n in zip(b, need))]
        if not fit:
            bins.append(list(whole))
            fit = [bins[-1]]

        def score(b):
            if rule == "norm":
                return sum(w * ((l - n) / c) ** 2 for w, l, n, c in zip(weights, b, need, whole))
            return -sum(w * l * n / c**2 for w, l, n, c in zip(weights, b, need, whole))

        best = min(fit, key=score)
        for i in range(3):
            best[i] -= need[i]
    return len(bins)


def documents(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    clashes = "piece start length block rank ids sequence_id offset n before at stretches".split()
    return df.selectExpr("*", *(f"'x' as {c}" for c in clashes))


def test_whole_library_ids(spark):
    rng = random.Random(5)
    texts = [(i, t) for i, t in enumerate(TEXTS)]
    texts += [(100 + i, "".join(rng.choice(TEXTS)[: rng.randrange(40)] for _ in range(12))) for i in range(80)]
    got = packing.pack_documents(documents(spark, texts).repartition(3), tokenizer=FILE).collect()
    check(got, texts)


def test_random_bytes_and_marks():
    """The encoder by pieces against the library, on strings of odd signs."""
    import pyarrow as pa

    rng = random.Random(9)
    signs = " '.,<|>abtsdAΣé̸́\n\t 1" + "漢"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(4000)]
    ids, at = packing.WordPieceEncoder(FILE).encode(pa.array(texts))
    plain = plain_tokenizer().encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [x.ids for x in plain]


def test_other_tokenizers_get_their_ids():
    import pyarrow as pa

    file = tokenizer_path("byte_bpe_50k.json")
    ids, at = packing.WordPieceEncoder(file).encode(pa.array(TEXTS))
    plain = plain_tokenizer(file).encode_batch(TEXTS, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [x.ids for x in plain]


@pytest.mark.parametrize("limits", [packing.Limits(64), packing.Limits(64, documents=5), packing.Limits(64, attention=900), packing.Limits(100, 3, 2500)])
@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_limits(spark, limits, rule):
    rng = random.Random(2)
    texts = [(i, prose(rng, int(rng.paretovariate(1.0)) % 120)) for i in range(150)] + ODD[:7]
    got = packing.pack_documents(documents(spark, texts).repartition(4), tokenizer=FILE, limits=limits, rule=rule).collect()
    used = check(got, texts, limits)
    assert used == one_by_one([r["length"] for r in got], limits, rule=rule)
    tokens, docs, attention = limits.vector()
    least = max(-(-sum(r["length"] for r in got) // tokens), -(-len(got) // docs), -(-sum(r["length"] ** 2 for r in got) // attention))
    assert used <= 1.25 * least + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    """Counts give as many sequences as single pieces do, and the plan does not grow with them."""
    rng = random.Random(seed)
    limits = packing.Limits(60, rng.choice([None, 4, 9]), rng.choice([None, 1500]))
    counts = Counter(min(limits.longest(), int(rng.expovariate(0.08)) + 1) for _ in range(800))
    for rule in ("norm", "dot"):
        out = packing.plan(counts, limits, rule=rule)
        used = set()
        for s, t in zip(out, [*out[1:], None]):
            n = (t.first if t and t.length == s.length else counts[s.length]) - s.first
            used |= {s.sequence + i // s.each for i in range(n)}
        assert len(used) == one_by_one(counts.elements(), limits, rule=rule)
    many = packing.plan({x: n * 10**7 for x, n in counts.items()}, limits)
    assert len(many) < 60 * 60


def test_few_sequences():
    rng = random.Random(1)
    counts = Counter(min(4096, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(200_000))
    out = packing.plan(counts)
    sequences = 1 + max(s.sequence for s in out)  # at least this many are named
    tokens = sum(x * n for x, n in counts.items())
    assert sequences <= 1.01 * -(-tokens // 4096) and len(out) < 50_000


def test_odd_rows(spark):
    got = packing.pack_documents(documents(spark, ODD), tokenizer=FILE, limits=packing.Limits(50)).collect()
    check(got, ODD, packing.Limits(50))


def test_copies_share_a_length(spark):
    """A third of the rows are one text; all of them are placed."""
    texts = [(i % 7, "one two three") for i in range(3000)] + [(i, f"w {i}") for i in range(100)]
    got = packing.pack_documents(documents(spark, texts).repartition(6), tokenizer=FILE).collect()
    assert check(got, texts) == -(-sum(r["length"] for r in got) // 4096)


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, [(1, "a")]).filter("false"), tokenizer=FILE).collect() == []


def test_bad_arguments():
    with pytest.raises(ValueError):
        packing.plan({1: 1}, rule="first")
    with pytest.raises(ValueError):
        packing.Limits(0).longest()
