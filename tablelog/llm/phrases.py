"""Phrase collocations from mergeable Misra-Gries summaries and an exact second pass (operator 11).

The occurrences of all n-grams of one to ``longest`` words are dealt by hash into buckets. A bucket's
summary has more counters than its mass (the occurrences in it) divided by the threshold, so what
a counter loses is less than the threshold and every frequent n-gram survives. Summaries add up: tasks
send counted keys and their mass, a bucket's task folds them in one after the other. Survivors become
bits of a filter of fixed size. The second pass counts n-grams that meet a bit by their text, dealt by
bucket again, and what reaches the threshold is exact. Cuts are scored by joins on these counts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelog.llm.storage import Storage, column
from tablelog.llm.words import Words, mix, ranges, shingles, text_bytes

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SEPARATORS = b" \t" + PIECE_ENDS

#: Occurrences of one bucket. Its task streams them and holds this divided by the threshold; at 100 TB
#: take 2**28, so that a block still sends several n-grams to each bucket.
BUCKET_MASS = 1 << 24
#: Counters of a summary, as a multiple of its mass divided by the threshold. Above 1 every frequent n-gram
#: survives; the more there are, the fewer others do.
SLACK = 8
#: Occurrences that a task counts together before it sends them, and texts it cuts in one step.
BLOCK = 1 << 21
STEP_BYTES = 1 << 20
#: Bits of the filter, as a power of two: 16 MB in each task. More survivors than bits cost time only.
FILTER_BITS = 27
#: Phrases that a task of the second pass holds before it sends their counts.
HELD = 1 << 18


# --- n-grams ----------------------------------------------------------------------------------------


class Grams:
    """The words of some rows, and which of them stand together in a piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        self.words = Words(texts, SEPARATORS)
        self.data, self.rows = text_bytes(texts)
        ends = np.zeros(256, bool)
        ends[list(PIECE_ENDS)] = True
        piece = np.cumsum(ends[self.data]) if len(self.data) else np.zeros(0, np.int64)
        count = self.words.counts()
        self.row = np.repeat(np.arange(len(count)), count)
        self.piece = piece[self.words.start] + self.row  # rows only add, so equal sums are one piece
        found = langs.dictionary_encode()
        self.langs = found.dictionary.to_pylist()
        self.lang = found.indices.to_numpy()
        seeds = [hashlib.blake2b(x.encode(), digest_size=8).digest() for x in self.langs]
        self.seed = np.frombuffer(b"".join(seeds), "<u8")[self.lang][self.row] if len(self.row) else np.zeros(0, np.uint64)

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all n-grams of ``k`` words with their language, and their first words."""
        hashes = shingles(self.words.hash, k)
        if not len(hashes):
            return hashes, np.zeros(0, np.int64)
        first = np.flatnonzero(self.piece[: len(hashes)] == self.piece[k - 1 :])
        return mix(hashes[first] ^ self.seed[first]), first

    def ends(self) -> np.ndarray:
        """Where each word ends."""
        inside = np.ones(256, bool)
        inside[list(SEPARATORS)] = False
        is_word = inside[self.data]
        last = is_word.copy()
        last[:-1] &= ~is_word[1:]
        edge = self.rows[1:][self.rows[1:] > 0] - 1
        last[edge] = is_word[edge]
        return np.flatnonzero(last) + 1


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    """Some rows at a time, by the bytes of their texts."""
    for batch in batches:
        size = np.cumsum(batch.column("size").to_numpy())
        a = 0
        while a < batch.num_rows:
            before = size[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(size, before + STEP_BYTES, "right")))
            yield Grams(batch.column("lang").slice(a, b - a), batch.column("text").slice(a, b - a))
            a = b


# --- first pass -------------------------------------------------------------------------------------

_SENT = "bucket long, kind int, mass long, keys binary, counts binary"
#: Keys in one row that a task sends: rows of a few hundred bytes keep Arrow batches small.
ROW_KEYS = 128


def bucketed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (from the upper half of the hash) and key within it (the lower half), as one number.

    Keys that share 32 bits count as one in a summary, which can only add survivors.
    """
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return (bucket << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def places(bucketed_keys: np.ndarray, bits: int) -> np.ndarray:
    """The bit of the filter that each key has."""
    return mix(bucketed_keys) >> np.uint64(64 - bits)


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Rows of bytes of ``data`` between edges."""
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data.tobytes())])


def _counted(longest: int, buckets: int, block: int):
    def send(hashes: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(hashes), return_counts=True)
        bucket = (values >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        size = np.diff(np.append(first, len(values)))
        rows = -(-size // ROW_KEYS)
        edges = np.append(np.repeat(first, rows) + ROW_KEYS * ranges(np.zeros(len(rows), np.int64), rows), len(values))
        # A bucket's mass sorts before its counts, so that its task knows the capacity from the start.
        n = len(first)
        edges = np.append(np.zeros(n, np.int64), edges)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(bucket[first], np.repeat(bucket[first], rows))),
                pa.array(np.repeat(np.array([0, 1], np.int32), [n, rows.sum()])),
                pa.array(np.append(np.add.reduceat(counts, first), np.zeros(rows.sum(), np.int64))),
                _binary(values.astype("<u4"), 4 * edges),
                _binary(counts.astype("<u4"), 4 * edges),
            ],
            ["bucket", "kind", "mass", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for grams in _steps(batches):
            for k in range(1, longest + 1):
                hashes, _ = grams.of(k)
                held.append(bucketed(hashes, buckets))
                size += len(hashes)
            if size >= block:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)

    return run


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters; ``lost`` bounds what each count lacks."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys = np.zeros(0, np.uint32)
        self.counts = np.zeros(0, np.int64)
        self.lost = 0
        self._more: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counted keys, or the counters of another summary (whose ``lost`` adds up as well)."""
        self._more.append((keys, counts))
        self._size += len(keys)
        if self._size >= max(self.capacity, 1 << 18):
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._more)])
        counts = np.concatenate([self.counts, *(n.astype(np.int64) for _, n in self._more)])
        self._more, self._size = [], 0
        if not len(keys):
            return
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[edge], np.add.reduceat(counts, edge)
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            least = int(np.partition(counts, at)[at])
            self.lost += least
            counts = counts - least
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def survivors(self, threshold: int) -> np.ndarray:
        """All keys that may have come ``threshold`` times."""
        self.settle()
        return self.keys[self.counts + self.lost >= threshold]


def _numbers(column: pa.Array, a: int, b: int) -> np.ndarray:
    """The 32-bit numbers in rows ``a`` to ``b``, which lie next to each other."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset + a : column.offset + b + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, "<u4", (at[-1] - at[0]) // 4, at[0]) if at[-1] > at[0] else np.zeros(0, "<u4")


def _survivors(threshold: int, bits: int, slack: int):
    """Bits of the filter, for the survivors of each bucket of this task."""

    def found(bucket: int, summary: Summary) -> pa.RecordBatch:
        keys = summary.survivors(threshold).astype(np.uint64) | np.uint64(bucket << 32)
        return pa.RecordBatch.from_pydict({"place": pa.array(np.unique(places(keys, bits)).astype(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, mass, summary = None, 0, None
        for batch in batches:
            own, kind, masses = (batch.column(x).to_numpy() for x in ("bucket", "kind", "mass"))
            edges = np.flatnonzero(np.append(True, (np.diff(own) != 0) | (np.diff(kind) != 0)))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)]):
                if own[a] != bucket:
                    if summary is not None:
                        yield found(bucket, summary)
                    bucket, mass, summary = int(own[a]), 0, None
                if kind[a] == 0:
                    mass += int(masses[a:b].sum())
                    continue
                summary = summary or Summary(slack * mass // threshold + 1)
                summary.add(_numbers(batch.column("keys"), a, b), _numbers(batch.column("counts"), a, b))
        if summary is not None:
            yield found(bucket, summary)

    return run


def _filter(found: DataFrame, bits: int) -> bytes:
    """The bits at all places, put together on the executors in 64 stretches of fixed size."""
    stretch = 1 << (bits - 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            for s in np.unique(place // stretch).tolist():
                mine = place[place // stretch == s] - s * stretch
                held.setdefault(s, np.zeros(stretch, bool))[mine] = True
        for s, flags in held.items():
            yield pa.RecordBatch.from_pydict({"stretch": pa.array([s]), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    dealt = found.repartition(64, F.floor(F.col("place") / stretch))
    out = np.zeros((64, stretch // 8), np.uint8)
    for r in dealt.mapInArrow(run, "stretch long, bits binary").collect():  # 64 rows of fixed size
        out[r["stretch"]] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


# --- second pass --------------------------------------------------------------------------------------

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_PACKED = "bucket long, lang array<string>, words array<int>, phrase array<string>, n array<long>"


def _exact(longest: int, buckets: int, held_most: int, bits: int, broadcast):
    """Counts of what meets a bit of the filter, many phrases of one bucket in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(broadcast.value, np.uint8)
        counts: dict[int, int] = {}
        names: dict[int, tuple[str, int, bytes]] = {}
        tokens: dict[str, int] = {}

        def send() -> pa.RecordBatch:
            for lang, n in tokens.items():  # the words of a language count as a phrase of no words
                names[-1 - len(names)] = (lang, 0, b"")
                counts[-len(names)] = n
            keys = np.array([h if h >= 0 else zlib.crc32(names[h][0].encode()) << 32 for h in names], np.uint64)
            bucket = (bucketed(keys, buckets) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            size = np.diff(np.append(first, len(order)))
            rows = -(-size // ROW_KEYS)
            edges = np.append(np.repeat(first, rows) + ROW_KEYS * ranges(np.zeros(len(rows), np.int64), rows), len(order))
            lang, words, phrase = zip(*names.values())
            by_bucket, ends = pa.array(order), pa.array(edges.astype(np.int32))
            columns = [pa.array(lang, pa.string()), pa.array(words, pa.int32()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array([counts[h] for h in names], pa.int64())]
            packed = [pa.ListArray.from_arrays(ends, x.take(by_bucket)) for x in columns]
            counts.clear(), names.clear(), tokens.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(bucket[order][first], rows)), *packed], ["bucket", "lang", "words", "phrase", "n"])

        for grams in _steps(batches):
            per_lang = np.bincount(grams.lang[grams.row], minlength=len(grams.langs))
            for lang, n in zip(grams.langs, per_lang.tolist()):
                tokens[lang] = tokens.get(lang, 0) + n
            low, starts, ends = grams.data.tobytes().translate(_LOWER), grams.words.start, grams.ends()
            for k in range(1, longest + 1):
                hashes, first = grams.of(k)
                place = places(bucketed(hashes, buckets), bits)
                kept = (flags[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                values, at, n = np.unique(hashes[kept], return_index=True, return_counts=True)
                at = first[kept][at]
                lang = grams.lang[grams.row[at]].tolist()
                for h, c, a, b, l in zip(values.tolist(), n.tolist(), starts[at].tolist(), ends[at + k - 1].tolist(), lang):
                    if h in counts:
                        counts[h] += c
                    else:
                        counts[h] = c
                        names[h] = (grams.langs[l], k, b" ".join(low[a:b].split()))
            if len(names) >= held_most:
                yield send()
        if names or tokens:
            yield send()

    return run


def _added(threshold: int):
    """The sums of all phrases that reach the threshold, one bucket after the other."""
    columns = ["lang", "words", "phrase", "n"]

    def added(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by(columns[:3]).aggregate([("n", "sum")]).rename_columns(columns)

    def done(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        sums = added(held)
        keep = pc.or_(pc.equal(sums["words"], 0), pc.greater_equal(sums["n"], threshold))
        yield from sums.filter(keep).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, size, limit = None, [], 0, HELD
        for batch in batches:
            own = batch.column("bucket").to_numpy()
            edges = np.flatnonzero(np.append(True, np.diff(own) != 0))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)]):
                if own[a] != bucket and held:
                    yield from done(held)
                    held, size, limit = [], 0, HELD
                bucket = own[a]
                held.append(pa.table([batch.column(x).slice(a, b - a).flatten() for x in columns], columns))
                size += len(held[-1])
                if size >= limit:
                    held = [added(held)]
                    size = len(held[0])
                    limit = max(HELD, 2 * size)
        if held:
            yield from done(held)

    return run


def phrase_counts(
    docs: DataFrame,
    *,
    threshold: int = 100,
    longest: int = 5,
    text: str = "text",
    lang: str = "lang",
    bucket_mass: int = BUCKET_MASS,
    block: int = BLOCK,
    filter_bits: int = FILTER_BITS,
    held: int = HELD,
    slack: int = SLACK,
) -> DataFrame:
    """``(lang, words, phrase, n)``: exact counts of all n-grams with ``threshold`` occurrences or more.

    A row with ``words`` 0 and an empty phrase holds the number of words of each language that has rows.
    NULL texts are empty, a NULL language is ``und``; equal rows all count; an empty table gives no rows.
    Within one block of a task n-grams are told apart by 64-bit hashes, between blocks by their text.
    """
    spark = docs.sparkSession
    storage = Storage(spark, "phrases")
    rows = docs.select(F.coalesce(column(docs, lang), F.lit("und")).alias("lang"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    rows = rows.withColumn("size", F.octet_length("text").cast("long"))
    size = rows.agg(F.sum("size")).first()[0] or 0
    # Words have five bytes or so with what parts them; a bucket that gets more is as right.
    buckets = max(1, -(-size * longest // (5 * bucket_mass)))
    sent = rows.mapInArrow(_counted(longest, buckets, block), _SENT)
    dealt = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
    found = storage.table(dealt.mapInArrow(_survivors(threshold, filter_bits, slack), "place long"), "places", clean=True)
    flags = spark.sparkContext.broadcast(_filter(found, filter_bits))  # fixed size
    packed = rows.mapInArrow(_exact(longest, buckets, held, filter_bits, flags), _PACKED)
    packed = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    counted = packed.mapInArrow(_added(threshold), "lang string, words int, phrase string, n long")
    out = storage.table(counted, "counts", clean=True)
    flags.unpersist()
    storage.drop("places")
    return out


def collocations(
    docs: DataFrame,
    *,
    threshold: int = 100,
    longest: int = 5,
    contained_percent: int = 100,
    top: int = 2000,
    scale: int = 1000,
    **options,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases.

    A phrase of two to ``longest`` words with ``a >= threshold`` occurrences is scored at the cut where
    ``floor(scale * a * n / (l * r))`` is least (the first of these), ``l`` and ``r`` being the counts of
    the two sides and ``n`` all words of the language. A phrase is dropped that stands in a longer one with
    at least ``contained_percent`` of its occurrences. Order: score and count descending, phrase ascending
    by bytes. Products are decimals of 38 digits, so scores are exact. Input as for ``phrase_counts``.
    """
    counts = phrase_counts(docs, threshold=threshold, longest=longest, **options)
    total = counts.filter("words = 0").select("lang", F.col("n").alias("n_words"))
    grams = counts.filter("words > 0")
    found = grams.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    # Every occurrence of a phrase within a longer one lies in one that is a word longer and as frequent.
    ends = F.array(F.slice("w", F.lit(1), F.col("words") - 1), F.slice("w", F.lit(2), F.col("words") - 1))
    inner = found.filter("words > 2").select("lang", F.explode(ends).alias("part"), "a")
    inner = inner.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    found = found.join(inner, ["lang", "phrase"], "left")
    found = found.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained_percent))

    cuts = found.join(total, "lang").select("lang", "phrase", "a", "n_words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    first = F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")
    rest = F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ")
    cuts = cuts.select("lang", "phrase", "a", "n_words", "k", first.alias("first"), rest.alias("rest"))
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    exact = "cast({} as decimal(20, 0))"
    score = F.expr(f"{exact.format('a')} * cast({scale} as decimal(10, 0)) * cast(n_words as decimal(18, 0)) div ({exact.format('l')} * cast(r as decimal(18, 0)))")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "a", "n_words").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("n_words").alias("n"), F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
