"""Documents packed into token sequences by vector best-fit (operator 13).

A piece of a document takes three things of a sequence: tokens, one of the documents that it may hold,
and attention cost, the square of the piece's length. Pieces come longest first; each goes into the open
sequence that has room for it in all three and is chosen by the least weighted norm of what would remain, or
by the greatest weighted dot product of what it takes with what is left.

What a piece takes follows from its length, so pieces of one length are alike and sequences with the same
residuals are. The plan is made for counts: the driver sees how many pieces have each length (as
many rows as a sequence has tokens), fills all sequences of a state in one step, and says for each length which
ranks go where. Ranks come from counts per task and length; no group is ever gathered.
"""

from __future__ import annotations

import json
import math
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelog.llm.storage import Storage, column
from tablelog.llm.token_files import PieceEncoder
from tablelog.llm.words import ranges

# --- fixed values: the pre-tokenizer of tokenizers that drop white space and mark the ends of words
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# ---


class WordPieceEncoder(PieceEncoder):
    """Ids by way of pieces, also for tokenizers that drop white space.

    With the pattern above nothing is merged over white space, nor between an ASCII letter and an
    ASCII mark, so pieces cut there can be encoded apart, many as the "words" of one text.
    """

    def __init__(self, file: str, remembered: int = 800_000):
        super().__init__(file, remembered)
        self.words = self.gap is None and self._splits_words(json.loads(self.tokenizer.to_str()))
        if self.words:
            self.gap = -1

    @staticmethod
    def _splits_words(spec: dict) -> bool:
        normal, before = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = [x["type"] for x in normal.get("normalizers", [])]
        split = (before.get("pretokenizers") or [{}])[0]
        plain = split.get("pattern") == {"Regex": WORD_PATTERN} and split.get("behavior") == "Removed" and split.get("invert")
        return bool(plain) and steps == NORMALIZERS and not any(x["normalized"] for x in spec.get("added_tokens", []))

    def _learn(self, data: np.ndarray, start: np.ndarray, hashes: np.ndarray, new: np.ndarray) -> None:
        if not self.words:
            return super()._learn(data, start, hashes, new)
        ends = np.append(start[1:], len(data))
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(start[new].tolist(), ends[new].tolist())]
        ids, sizes = [], []
        for a in range(0, len(texts), 16384):
            some = texts[a : a + 16384]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, self.kind))
            of = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
            sizes.append(np.bincount(of, minlength=len(some)))
        self.known.add(hashes[new], np.concatenate(sizes), ids)


def encoder_of_worker(file: str) -> WordPieceEncoder:
    """The encoder of this Python worker, which tasks after this one find again."""
    held = sys.modules.setdefault("_packing_worker", types.ModuleType("_packing_worker")).__dict__
    if file not in held:
        held[file] = WordPieceEncoder(file)
    return held[file]


# --- the plan -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Limits:
    """What one sequence holds. ``documents`` and ``attention`` are unlimited where None."""

    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        # Every piece has a token, and squares add up to the square of the sum at most.
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        if min(self.tokens, documents, attention) < 1:
            raise ValueError("a sequence must hold at least one token")
        return np.array([self.tokens, documents, attention], np.int64)

    def longest(self) -> int:
        """The length of the longest piece that fits an empty sequence."""
        tokens, _, attention = self.vector().tolist()
        return min(tokens, math.isqrt(attention))


@dataclass(frozen=True)
class Stretch:
    """Pieces of one length from rank ``first`` on: ``each`` of them to a sequence, from ``sequence`` on, the
    first of them at ``offset``."""

    length: int
    first: int
    each: int
    sequence: int
    offset: int


class _States:
    """Open sequences by what is left in them; of each state the runs of sequence numbers."""

    def __init__(self):
        self.left = np.zeros((64, 3), np.int64)
        self.used = 0
        self.runs: list[list[tuple[int, int]]] = []
        self.number: dict[tuple[int, int, int], int] = {}

    def put(self, left: tuple[int, int, int], first: int, count: int) -> None:
        if min(left) < 1:
            return  # full
        at = self.number.get(left)
        if at is None:
            at = self.number[left] = self.used
            if self.used == len(self.left):
                self.left = np.concatenate([self.left, np.zeros_like(self.left)])
            self.left[at] = left
            self.runs.append([])
            self.used += 1
        runs = self.runs[at]
        if runs and runs[-1][0] + runs[-1][1] == first:
            runs[-1] = (runs[-1][0], runs[-1][1] + count)
        else:
            runs.append((first, count))

    def drop_empty(self) -> None:
        kept = [i for i in range(self.used) if self.runs[i]]
        self.left[: len(kept)] = self.left[kept]
        self.runs = [self.runs[i] for i in kept]
        self.used = len(kept)
        self.number = {tuple(self.left[i].tolist()): i for i in range(self.used)}


def plan(counts: dict[int, int], limits: Limits = Limits(), *, weights=(1.0, 0.01, 0.01), rule: str = "norm") -> list[Stretch]:
    """Where pieces go, of which there are ``counts[length]``: best-fit, longest first, under every limit.

    By ``norm`` a piece takes the sequence with the least weighted square of what remains after it, relative to
    the limits; by ``dot`` the one with the greatest weighted product of what it takes and what is left. Equal
    choices go to the state opened first. The work and the plan grow with the number of lengths and states,
    which the limits bound, and not with the counts.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule}")
    whole = limits.vector()
    share = np.array(weights) / whole.astype(float) ** 2
    states, out, sequences = _States(), [], 0

    def fill(length: int, need: np.ndarray, n: int, left: np.ndarray, runs: list, first: int) -> int:
        """Put up to ``n`` pieces into sequences of one state; how many went, the rest of the runs going back."""
        fits = int((left // need).min())
        # Once one piece is in, its sequence is the best by norm for the next; by product it is not.
        each = fits if rule == "norm" else 1
        gone = 0
        while runs and gone < n:
            start, count = runs.pop(0)
            full = min(count, (n - gone) // each)
            if full:
                out.append(Stretch(length, first + gone, each, start, int(whole[0] - left[0])))
                gone += full * each
                states.put(tuple((left - each * need).tolist()), start, full)
                start, count = start + full, count - full
            rest = n - gone
            if count and 0 < rest < each:
                out.append(Stretch(length, first + gone, each, start, int(whole[0] - left[0])))
                gone += rest
                states.put(tuple((left - rest * need).tolist()), start, 1)
                start, count = start + 1, count - 1
            if count:
                runs.insert(0, (start, count))
        return gone

    for length in sorted(counts, reverse=True):
        n, first = counts[length], 0
        need = np.array([length, 1, length * length], np.int64)
        states.drop_empty()
        while n > 0:
            open_ = states.left[: states.used]
            fit = np.flatnonzero((open_ >= need).all(1) & np.fromiter(map(bool, states.runs), bool, states.used))
            if len(fit):
                left = open_[fit]
                score = (share * (left - need) ** 2).sum(1) if rule == "norm" else -(share * left * need).sum(1)
                at = int(fit[score.argmin()])
                gone = fill(length, need, n, states.left[at].copy(), states.runs[at], first)
            else:
                fits = int((whole // need).min()) if rule == "norm" else 1
                if fits < 1:
                    raise ValueError(f"a piece of {length} tokens fits no sequence")
                opened = -(-n // fits) if rule == "norm" else 1
                gone = fill(length, need, n, whole, [(sequences, opened)], first)
                sequences += opened
            n, first = n - gone, first + gone
    return out


# --- tasks --------------------------------------------------------------------------------------------


def _pieces(tokenizer: str, end_id: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of_worker(tokenizer)
        block = TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, np.int64)  # pieces of this task, by length
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                ids, edge = encoder.encode(some.column("text"))
                ids = np.insert(ids.astype("<u4"), edge[1:], end_id)
                size = np.diff(edge) + 1
                begin = np.cumsum(size) - size
                cuts = -(-size // longest)
                row = np.repeat(np.arange(len(size)), cuts)
                piece = ranges(np.zeros(len(size), np.int64), cuts)
                start = piece * longest
                length = np.minimum(size[row] - start, longest)
                order = np.argsort(length, kind="stable")
                values, first, n = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(length)) - np.repeat(first - seen[values], n)
                seen[values] += n
                raw = ids.tobytes()
                spans = zip((4 * (begin[row] + start)).tolist(), (4 * (begin[row] + start + length)).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id").take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(np.full(len(row), block, np.int32)),
                        pa.array(rank),
                        pa.array([raw[a:b] for a, b in spans], pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "block", "rank", "ids"],
                )

    return run


def pack_documents(
    docs: DataFrame,
    *,
    tokenizer: str,
    end_id: int = 1,
    limits: Limits = Limits(),
    weights=(1.0, 0.01, 0.01),
    rule: str = "norm",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids, sequence_id, offset)``, a row for each piece.

    ``ids`` are those of the library's ``encode(text, add_special_tokens=False)`` and ``end_id``, as little-endian
    unsigned 32-bit integers. A document is cut only where it is longer than any piece may be; ``start``
    counts its ids before the piece. In each sequence the pieces follow each other without a gap from
    ``offset`` 0, and no limit is passed. NULL and empty texts have the end id alone. NULL keys and
    equal rows are documents like others. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    storage = Storage(spark, "packing")
    rows = docs.select(column(docs, key).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, block int, rank long, ids binary"
    pieces = storage.table(rows.mapInArrow(_pieces(tokenizer, end_id, limits.longest()), fields), "pieces")

    # A window holds one row for each task that met its length.
    sizes = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = storage.table(sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row per length
    stretches: dict[int, list] = {x: [] for x in counts}
    for s in plan(counts, limits, weights=weights, rule=rule):
        stretches[s.length].append((s.first, s.each, s.sequence, s.offset))
    fields = "length long, stretches array<struct<first: long, each: long, sequence: long, offset: long>>"
    places = spark.createDataFrame(list(stretches.items()), fields)

    found = pieces.join(sizes.select("length", "block", "before"), ["length", "block"]).join(F.broadcast(places), "length")
    found = found.withColumn("rank", F.col("before") + F.col("rank"))
    found = found.withColumn("at", F.element_at(F.filter("stretches", lambda s: s["first"] <= F.col("rank")), -1))
    turn = F.col("rank") - F.col("at.first")
    return found.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids",
        (F.col("at.sequence") + F.floor(turn / F.col("at.each"))).alias("sequence_id"),
        (F.col("at.offset") + turn % F.col("at.each") * F.col("length")).alias("offset"),
    )
