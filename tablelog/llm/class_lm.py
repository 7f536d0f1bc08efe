"""Perplexity under a Brown class-based bigram model (operator 4).

    P(w | previous) = P(class of w | class of previous) * P(w | class of w)

1. Count all words of the training documents; the ``heads`` most frequent ones are the heads.
2. Count the pairs of neighbours among heads, text ends and "another word".
3. Exchange clustering: heads begin in classes by rank; in each round every head in turn moves to
   the class that gives the training pairs the highest likelihood, until few move. The counts of
   pairs of heads, whose size is a parameter, are the only table that the driver holds.
4. Every other training word joins the class that its neighbours' classes vote for. Then all of these
   words move in rounds, however many there are: each goes to the class that gives its own neighbours,
   as they are classed before the round, the highest likelihood. Heads stay. The same step gathers all words' counts: documents fall into chunks by hash, each chunk asks the buckets of the
   vocabulary for its own distinct words, so no table of all words is ever in one place.
5. Each chunk meets its answers; a document keeps its emission score and its class pairs. The pairs
   of training documents sum to the transition matrix, with which all pairs are scored.

A word that training has not seen is drawn from any class by its share of unseen words; after it
classes come by their overall frequency. All distributions sum to 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.llm.storage import Storage, column
from tablelog.llm.words import SPACE, Words

HEADS = 4000
CLASSES = 40
ROUNDS = 8
#: Rounds in which all other words move, each of which reads the text once more.
ALL_ROUNDS = 2
#: Text of a chunk and of a vocabulary bucket, in bytes; tokens that a task counts at a time.
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20
FLUSH = 4 << 20
#: Rows of a batch that a task works on at a time.
STEP_ROWS = 400
#: Words of a bucket whose neighbours are added up at a time.
STEP_WORDS = 1 << 16
#: Text whose counts of neighbours are added up at a time, in bytes, and such sums after that.
PART_BYTES = 256 << 20
PARTS = 16

_SLOTS = 22


def held_out(key: Column) -> Column:
    """True for the fifth of the keys that nothing is learned from; a NULL key is not one."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


class Heads:
    """Numbers of the heads by hash. Heads that would share a slot are left out beforehand."""

    def __init__(self, hashes: np.ndarray):
        slot, first = np.unique(hashes >> np.uint64(64 - _SLOTS), return_index=True)
        self.hashes = hashes[np.sort(first)]
        self.table = np.full(1 << _SLOTS, len(self.hashes), np.int32)
        self.table[self.hashes >> np.uint64(64 - _SLOTS)] = np.arange(len(self.hashes))
        self.padded = np.append(self.hashes, np.uint64(0))

    def __len__(self) -> int:
        return len(self.hashes)

    def __getstate__(self):
        return self.hashes

    def __setstate__(self, hashes):
        self.__init__(hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, ``len(self)`` for others."""
        number = self.table[hashes >> np.uint64(64 - _SLOTS)]
        return np.where(self.padded[number] == hashes, number, len(self))


# --- counting -------------------------------------------------------------------------------------


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, n = np.unique(values, return_counts=True)
    return found, n


def _summed(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the sums of their counts."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _by_bucket(words: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Stretches of sorted words by bucket, a range of hashes."""
    step = (1 << 64) // buckets + 1
    edges = np.searchsorted(words, np.array([min(i * step, (1 << 64) - 1) for i in range(buckets)], np.uint64))
    edges = np.append(edges, len(words))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(edges[b], edges[b + 1])


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in table[name]]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _word_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                held.append(Words(batch.column(0).slice(start, STEP_ROWS), SPACE).hash)
                if sum(map(len, held)) > FLUSH:
                    yield send(held)
                    held = []
        if held:
            yield send(held)

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        words, n = _counted(np.concatenate(held))
        rows = [(b, words[s].tobytes(), n[s].astype("<i8").tobytes()) for b, s in _by_bucket(words, buckets)]
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["bucket", "words", "n"])

    return run


def _most_frequent(heads: int):
    def run(parts: pa.Table) -> pa.Table:
        words, n = _summed(_column(parts, "words", np.uint64), _column(parts, "n", "<i8"))
        most = np.lexsort((words, -n))[:heads]
        return pa.table({"word": words[most].view(np.int64), "n": n[most]})

    return run


# --- neighbours and classes -----------------------------------------------------------------------


def _sequence(words: Words, symbol: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all documents, each after and before an ``end``; and which places are words."""
    n = words.counts()
    docs = len(n)
    out = np.full(len(symbol) + docs + 1, end, np.int64)
    place = np.arange(len(symbol)) + np.repeat(np.arange(docs), n) + 1
    out[place] = symbol
    return out, place


def _pairs(heads: Heads, block: int):
    """Counts of neighbours, sent to the block of the first symbol."""
    symbols = len(heads) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                words = Words(batch.column(0).slice(start, STEP_ROWS), SPACE)
                seq, _ = _sequence(words, heads.find(words.hash), symbols - 1)
                held.append(seq[:-1] * symbols + seq[1:])
                if sum(map(len, held)) > FLUSH:
                    yield send(held)
                    held = []
        if held:
            yield send(held)

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs, n = _counted(np.concatenate(held))
        edges = np.searchsorted(pairs, np.arange(0, symbols + block, block) * symbols)
        part = TaskContext.get().partitionId()
        rows = []
        for b in np.flatnonzero(np.diff(edges)):
            s = slice(edges[b], edges[b + 1])
            rows.append((int(b), part, pairs[s].astype("<i8").tobytes(), n[s].astype("<i8").tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], _PAIR_NAMES)

    return run


_PAIR_NAMES = ["block", "part", "pair", "n"]
_PAIRS = "block long, part long, pair binary, n binary"


def _sum_pairs(key: tuple, parts: pa.Table) -> pa.Table:
    pairs, n = _summed(_column(parts, "pair", "<i8"), _column(parts, "n", "<i8"))
    return pa.table([*([x] for x in key), [pairs.tobytes()], [n.astype("<i8").tobytes()]], _PAIR_NAMES)


def neighbours(training: DataFrame, heads: Heads, block: int, size: int) -> DataFrame:
    """Counts of neighbours by block of the first symbol, one row each.

    Sums are added up in a tree, so that no task reads more of them the more text there is.
    """
    parts = max(1, -(-size // PART_BYTES))
    sums = training.mapInArrow(_pairs(heads, block), _PAIRS)
    while True:
        sums = sums.withColumn("part", F.pmod("part", F.lit(parts)))
        sums = sums.groupBy("block", "part").applyInArrow(_sum_pairs, _PAIRS)
        if parts == 1:
            return sums.drop("part")
        parts = -(-parts // PARTS)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(counts: np.ndarray, class_of: np.ndarray, movable: int, open_classes: int, rounds: int) -> np.ndarray:
    """Move each of the first ``movable`` symbols in turn to its best class, in place; until under a
    two-hundredth of them moves in a round. Returns how often each class follows each.

    The likelihood of the pairs changes by what the symbol's neighbours, as they are classed at that
    moment, add to rows and columns of the class pairs; it never falls.
    """
    classes = int(class_of.max()) + 1
    one = np.eye(classes, dtype=np.float32)[class_of]
    right, left = ((x @ one).astype(np.float64) for x in (counts, counts.T))  # of each symbol, by class of the neighbour
    m = one.T @ right
    for _ in range(rounds):
        moved = 0
        for w in range(movable):
            old, self_ = class_of[w], counts[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[old] -= self_
            l[old] -= self_
            m[old] -= r
            m[:, old] -= l
            m[old, old] -= self_
            np.maximum(m, 0, out=m)
            rows, columns, diagonal = m.sum(1) + l, m.sum(0) + r, m.diagonal()
            gain = (_xlogx(m + r) - _xlogx(m)).sum(1) + (_xlogx(m + l[:, None]) - _xlogx(m)).sum(0)
            gain += _xlogx(diagonal + r + l + self_) + _xlogx(diagonal) - _xlogx(diagonal + r) - _xlogx(diagonal + l)
            gain -= _xlogx(rows + r.sum() + self_) - _xlogx(rows) + _xlogx(columns + l.sum() + self_) - _xlogx(columns)
            new = int(gain[:open_classes].argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            m[new] += r
            m[:, new] += l
            m[new, new] += self_
            if new != old:
                moved += 1
                class_of[w] = new
                for table, of in ((right, counts[:, w]), (left, counts[w])):
                    table[:, old] -= of
                    table[:, new] += of
        if moved <= movable // 200:
            break
    return m


def cluster(pairs: DataFrame, symbols: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all symbols, and how often each class follows each (head classes, "another", end)."""
    counts = np.zeros((symbols, symbols), np.float32)  # fixed by the number of heads
    for _, pair, n in pairs.select("block", "pair", "n").toLocalIterator():
        np.put(counts, np.frombuffer(pair, "<i8"), np.frombuffer(n, "<i8"))
    heads = symbols - 2
    class_of = np.append(np.arange(heads) % classes, [classes, classes + 1])
    return class_of, exchange(counts, class_of, heads, classes, rounds)


# --- vocabulary and chunks ------------------------------------------------------------------------


@dataclass
class Classes:
    """heads, their classes and counts; vote[a, b]: likeliest class between classes a and b."""

    heads: Heads
    class_of: np.ndarray
    vote: np.ndarray
    classes: int


def _votes(matrix: np.ndarray, classes: int) -> np.ndarray:
    share = matrix[:, :classes] + 0.5
    follow = matrix[:classes] + 0.5
    share, follow = np.log(share / share.sum(1, keepdims=True)), np.log(follow / follow.sum(1, keepdims=True))
    return (share[:, None, :] + follow.T[None, :, :]).argmax(2).astype(np.uint8)


def _requests(known: Classes, buckets: int):
    """A chunk's distinct words that are no heads, with training counts, and all votes for each."""
    number = len(known.heads)
    heads_class = np.append(known.class_of[:number], [known.classes, known.classes + 1])

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        rows = []
        for training in (True, False):
            part = docs.filter(pa.compute.equal(docs["held_out"], not training))
            if not len(part):
                continue
            words = Words(part["text"].combine_chunks(), SPACE)
            symbol = known.heads.find(words.hash)
            seq, place = _sequence(words, symbol, number + 1)
            seq = heads_class[seq]
            tail = symbol == number
            at, hashes = place[tail], words.hash[tail]
            vote = known.vote[seq[at - 1], seq[at + 1]].astype(np.int64)
            rows.append((hashes, vote if training else np.full(len(at), -1)))
        hashes, vote = (np.concatenate(x) for x in zip(*rows)) if rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.lexsort((vote, hashes))
        hashes, vote = hashes[order], vote[order]
        change = np.append(True, (hashes[1:] != hashes[:-1]) | (vote[1:] != vote[:-1])) if len(hashes) else np.zeros(0, bool)
        first = np.flatnonzero(change)
        n = np.diff(np.append(first, len(hashes)))
        hashes, vote = hashes[first], vote[first]
        n = np.where(vote < 0, 0, n)
        new = np.append(True, hashes[1:] != hashes[:-1]) if len(hashes) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        total = np.add.reduceat(n, first) if len(first) else n[:0]
        words, owner = hashes[first], np.cumsum(new) - 1
        cast = (vote >= 0).nonzero()[0]
        owner, vote, n = owner[cast], vote[cast], n[cast]
        return _to_buckets(key, words, total, owner, vote, n, buckets)

    return run


_ASKED = "chunk long, bucket long, words binary, n binary, owner binary, vote binary, times binary"


def _to_buckets(key: tuple, words: np.ndarray, total: np.ndarray, owner: np.ndarray, vote: np.ndarray, times: np.ndarray, buckets: int, *more: tuple) -> pa.Table:
    """Sorted words with their counts, and votes in the order of the words that own them, by bucket."""
    out = list(more)
    for b, s in _by_bucket(words, buckets):
        v = slice(*np.searchsorted(owner, [s.start, s.stop]))
        votes = ((owner[v] - s.start).astype("<u4"), vote[v].astype("<u2"), times[v].astype("<u4"))
        out.append((key[0].as_py(), b, words[s].tobytes(), total[s].astype("<u4").tobytes(), *(x.tobytes() for x in votes)))
    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 5)
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], [x.split()[0] for x in _ASKED.split(", ")])


def _cells(known: Classes, buckets: int):
    """A chunk's words again, with how often each class stands before and after them in training text.

    One more row, bucket -1, has how often each class follows each in the chunk.
    """
    number, width = len(known.heads), known.classes + 2

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        part = docs.filter(pa.compute.invert(docs["held_out"]))
        tail, tail_class = _column(answers, "words", np.uint64), _column(answers, "class", np.uint8)
        order = np.argsort(tail)
        tail, tail_class = tail[order], tail_class[order]
        words = Words(pa.concat_arrays(part["text"].chunks or [pa.array([], pa.string())]), SPACE)
        symbol = known.heads.find(words.hash)
        rest = np.flatnonzero(symbol == number)
        spot = np.searchsorted(tail, words.hash[rest])
        group = np.append(known.class_of[:number], 0)[symbol]
        group[rest] = tail_class[spot]
        seq, place = _sequence(words, group, known.classes + 1)
        at = place[rest]
        cell, times = _counted(np.concatenate([spot * 2 * width + seq[at - 1], (spot * 2 + 1) * width + seq[at + 1]]))
        pairs = np.bincount(seq[:-1] * width + seq[1:], minlength=width * width).astype("<i8").tobytes()
        total = np.bincount(spot, minlength=len(tail))
        return _to_buckets(key, tail, total, cell // (2 * width), cell % (2 * width), times, buckets, (key[0].as_py(), -1, pairs, b"", b"", b"", b""))

    return run


def _sum_matrices(parts: pa.Table) -> pa.Table:
    return pa.table({"pairs": [sum(np.frombuffer(x.as_buffer(), "<i8") for x in parts["words"]).astype("<i8").tobytes()]})


def _gains(matrix: np.ndarray, classes: int) -> np.ndarray:
    """By classes before, then classes after: what a neighbour adds to the log likelihood in each class."""
    m = matrix + 0.5
    before = np.log(m[:, :classes] / m[:, :classes].sum(0))
    after = np.log(m[:classes] / m[:classes].sum(1, keepdims=True))
    return np.concatenate([before, after.T])


def _answers(classes: int, gains: np.ndarray | None = None):
    """A bucket's words: counts of all training documents and classes, for each chunk that asked.

    The class is the one with most votes, or of the greatest sum of ``gains`` of the neighbours.

    One more row, chunk -1, has per class the words and their total count.
    """

    def run(key: tuple, asked: pa.Table) -> pa.Table:
        words, n, owner, vote, times = (_column(asked, *x) for x in (("words", np.uint64), ("n", "<u4"), ("owner", "<u4"), ("vote", "<u2"), ("times", "<u4")))
        distinct, index = np.unique(words, return_inverse=True)
        ends = np.cumsum([0, *(len(x.as_buffer()) // 8 for x in asked["words"])])
        owner = index[owner + np.repeat(ends[:-1], [len(x.as_buffer()) // 2 for x in asked["vote"]])]  # of each vote
        total = np.bincount(index, n, len(distinct)).astype(np.int64)
        width = classes if gains is None else len(gains)
        cell, sums = _summed(owner.astype(np.int64) * width + vote, times.astype(np.int64))
        best = np.zeros(len(distinct), np.int64)
        for a in range(0, len(distinct), STEP_WORDS):
            own = best[a : a + STEP_WORDS]
            s = slice(*np.searchsorted(cell, [a * width, (a + len(own)) * width]))
            weight = np.zeros(len(own) * width)
            weight[cell[s] - a * width] = sums[s]
            weight = weight.reshape(-1, width)
            own[:] = (weight if gains is None else weight @ gains).argmax(1)
        seen = total > 0
        per_class = np.stack([np.bincount(best[seen], minlength=classes), np.bincount(best[seen], total[seen], classes).astype(np.int64)])
        cut = lambda x, kind: [x[index[a:b]].astype(kind).tobytes() for a, b in zip(ends, ends[1:])]
        return pa.table(
            {
                "chunk": pa.concat_arrays([asked["chunk"].combine_chunks(), pa.array([-1], pa.int64())]),
                "words": pa.concat_arrays([asked["words"].combine_chunks().cast(pa.binary()), pa.array([b""], pa.binary())]),
                "n": pa.array([*cut(total, "<i8"), per_class.astype("<i8").tobytes()], pa.binary()),
                "class": pa.array([*cut(best, np.uint8), b""], pa.binary()),
            }
        )

    return run


@dataclass
class Statistics:
    """head_n: counts of heads. words, tokens: distinct words and their total by class. ends: texts."""

    head_n: np.ndarray
    words: np.ndarray
    tokens: np.ndarray
    ends: int

    @property
    def all_tokens(self) -> int:
        return int(self.tokens.sum()) + self.ends

    @property
    def all_words(self) -> int:
        return int(self.words.sum()) + (self.ends > 0)


def _documents(known: Classes, stats: Statistics):
    """Per document: counts, base score, emission score, and its class pairs with their counts."""
    number, classes = len(known.heads), known.classes
    n_all, v_all = stats.all_tokens, stats.all_words
    room = stats.tokens + 0.5 * (stats.words + 1)
    end, unknown = classes, classes + 1

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        text = docs["text"].combine_chunks()
        words = Words(text, SPACE)
        tail, tail_n, tail_class = (_column(answers, *x) for x in (("words", np.uint64), ("n", "<i8"), ("class", np.uint8)))
        order = np.argsort(tail)
        tail, tail_n, tail_class = tail[order], tail_n[order], tail_class[order]
        symbol = known.heads.find(words.hash)
        n = np.append(stats.head_n, 0)[symbol]
        group = np.append(known.class_of[:number], 0)[symbol]
        rest = np.flatnonzero(symbol == number)
        spot = np.searchsorted(tail, words.hash[rest])
        n[rest], group[rest] = tail_n[spot], tail_class[spot]
        group = np.where(n > 0, group, unknown)
        emission = np.where(n > 0, np.log10((n + 0.5) / np.append(room, [1, 1])[group]), 0.0)
        base = np.log10((n + 0.5) / (n_all + 0.5 * (v_all + 1)))
        counts = words.counts()
        total = lambda x: np.diff(np.append(0, np.cumsum(x))[words.row])
        sums = lambda x: np.array([x[a:b].sum() for a, b in zip(words.row, words.row[1:])])
        ending = np.log10((stats.ends + 0.5) / (n_all + 0.5 * (v_all + 1)))
        seq, _ = _sequence(words, group, end)
        width = classes + 2
        pair = seq[:-1] * width + seq[1:]
        doc = np.repeat(np.arange(len(counts)), counts + 1)
        cell, times = _counted(doc * width * width + pair)
        edges = np.searchsorted(cell, np.arange(len(counts) + 1) * width * width)
        cell = (cell % (width * width)).astype(np.int32)
        ends = pa.array(edges.astype(np.int32))
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                "held_out": docs["held_out"],
                "n_tokens": counts + 1,
                "n_known": total((n > 0).astype(np.int64)) + (stats.ends > 0),
                "base_score": sums(base) + ending,
                "emission": sums(emission),
                "pair": pa.ListArray.from_arrays(ends, pa.array(cell)),
                "times": pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
            }
        )

    return run


def transitions(matrix: np.ndarray, stats: Statistics, classes: int) -> np.ndarray:
    """log10 of each class after each; the column "unknown" has an unseen word as a whole."""
    end, unknown = classes, classes + 1
    m = matrix.copy()
    m[:, unknown] = m[unknown] = 0
    overall = m[:, : classes + 1].sum(0) + 0.5
    overall /= overall.sum()
    share = (m[:, : classes + 1] + 5 * overall) / (m[:, : classes + 1].sum(1, keepdims=True) + 5)
    share[unknown] = overall
    unseen = 0.5 / (stats.tokens + 0.5 * (stats.words + 1))
    out = np.empty((classes + 2, classes + 2))
    out[:, : end + 1] = np.log10(share)
    out[:, unknown] = np.log10((share[:, :classes] * unseen).sum(1))
    return out


def _scored(table: np.ndarray):
    flat = table.ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, times = batch.column("pair"), batch.column("times")
            at = pair.offsets.to_numpy()
            value = flat[pair.flatten().to_numpy()] * times.flatten().to_numpy()
            score = batch.column("emission").to_numpy() + (np.add.reduceat(value, at[:-1]) if len(value) else 0.0)
            names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(score)], [*names, "score"])

    return run


def class_perplexity(
    docs: DataFrame,
    *,
    heads: int = HEADS,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
    all_rounds: int = ALL_ROUNDS,
    key: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Tokens are words (runs of bytes other than ASCII white space, A-Z lower-cased) and one end. The
    model learns from all rows but those whose key is held out. ``base_score`` is the log10
    probability under add-half unigrams, ``score`` that under the class model; perplexity is
    ``10 ** (-score / n_tokens)``. A NULL or empty text has an end alone. A NULL key counts as
    training. Equal rows are all learned from and all returned. Without training rows every token is
    unknown and classes are uniform. An empty table gives no rows. Other columns are ignored. There are
    255 classes at most.
    """
    if not 1 <= classes <= 255:
        raise ValueError(f"a word's class is kept in a byte, so classes must be 1 to 255, not {classes}")
    spark = docs.sparkSession
    storage = Storage(spark, "class-lm")
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(column(docs, key).alias("doc_id"), held_out(column(docs, key)).alias("held_out"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    size, ends = rows.agg(F.sum(F.octet_length("text").cast("long")), F.sum((~F.col("held_out")).cast("long"))).first()
    size, ends = size or 0, ends or 0
    chunks, buckets = max(1, -(-size // chunk_bytes)), max(8, -(-size // BUCKET_BYTES))
    training = rows.filter(~F.col("held_out")).select("text")

    sent = training.mapInArrow(_word_counts(buckets), "bucket long, words binary, n binary")
    most = sent.groupBy("bucket").applyInArrow(_most_frequent(heads), "word long, n long")
    most = most.orderBy(F.desc("n"), "word").limit(heads).collect()  # ``heads`` rows at most
    found = Heads(np.array([r["word"] for r in most], np.int64).view(np.uint64))
    count = dict(zip(np.array([r["word"] for r in most], np.int64).view(np.uint64).tolist(), (r["n"] for r in most)))
    head_n = np.array([count[h] for h in found.hashes.tolist()], np.int64)

    symbols, block = len(found) + 2, 64
    pairs = storage.table(neighbours(training, found, block, size), "pairs", clean=True)
    class_of, matrix = cluster(pairs, symbols, classes, rounds)
    storage.drop("pairs")
    known = Classes(found, class_of, _votes(matrix, classes), classes)

    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    asked = dealt.groupBy("chunk").applyInArrow(_requests(known, buckets), _ASKED)
    fields = "chunk long, words binary, n binary, class binary"
    answers = storage.table(asked.groupBy("bucket").applyInArrow(_answers(classes), fields), "answers", clean=True)
    for turn in range(all_rounds):
        cells = dealt.groupBy("chunk").cogroup(answers.filter("chunk >= 0").groupBy("chunk")).applyInArrow(_cells(known, buckets), _ASKED)
        cells = storage.table(cells, "cells", clean=True)
        sums = cells.filter("bucket < 0").groupBy(F.pmod("chunk", F.lit(64))).applyInArrow(_sum_matrices, "pairs binary").collect()  # 64 rows at most
        matrix = sum((np.frombuffer(r["pairs"], "<i8") for r in sums), np.zeros((classes + 2) ** 2)).reshape(classes + 2, classes + 2)
        moved = cells.filter("bucket >= 0").groupBy("bucket").applyInArrow(_answers(classes, _gains(matrix, classes)), fields)
        answers = storage.table(moved, f"answers-{turn}", clean=True)
        storage.drop("cells")
        storage.drop(f"answers-{turn - 1}" if turn else "answers")
    per_class = sum((np.frombuffer(r["n"], "<i8").reshape(2, -1) for r in answers.filter("chunk < 0").select("n").collect()), np.zeros((2, classes), np.int64))
    own = class_of[: len(found)]
    stats = Statistics(
        head_n,
        per_class[0] + np.bincount(own, minlength=classes),
        per_class[1] + np.bincount(own, head_n, classes).astype(np.int64),
        ends,
    )

    fields = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, emission double, pair array<int>, times array<int>"
    scored = dealt.groupBy("chunk").cogroup(answers.filter("chunk >= 0").groupBy("chunk")).applyInArrow(_documents(known, stats), fields)
    scored = storage.table(scored, "documents", clean=True)
    storage.drop(f"answers-{all_rounds - 1}" if all_rounds else "answers")
    cells = scored.filter(~F.col("held_out")).select(F.explode(F.arrays_zip("pair", "times")).alias("x"))
    matrix = np.zeros((classes + 2) ** 2)
    for cell, n in cells.groupBy("x.pair").agg(F.sum("x.times")).collect():  # (classes + 2) ** 2 rows at most
        matrix[cell] = n
    table = transitions(matrix.reshape(classes + 2, classes + 2), stats, classes)
    out = scored.mapInArrow(_scored(table), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(stats.all_tokens).cast("long").alias("train_tokens"), "base_score", "score")
