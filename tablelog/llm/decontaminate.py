"""Benchmark passages in documents by a prefix-filtered set join (operator 5).

A window is ``window`` words in a row of a benchmark item; a shorter item is one window. Its set are
its shingles of ``shingle`` words (a still shorter item is one shingle). A document holds a window
only if it holds all shingles of it, so for containment the prefix that must be joined is a single
one. Shingles are ordered by how often documents hold them, and each window joins on its rarest:

1. one pass over the texts keeps, per document, where shingles of the benchmark stand;
2. counting these gives the order, and each window its rarest shingle;
3. a place of that shingle gives a candidate; it must leave room for the words of the window before
   and after it (positional and length bounds), and all other shingles of the window must stand at
   their places next to it (the exact check).

The benchmark is the bounded side: its shingles go to all tasks, in blocks of ``block_bytes`` of
text. A larger benchmark takes more passes over the documents, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelog.llm.storage import ROW, Storage, as_struct, column, row_hashes
from tablelog.llm.words import NOT_ALNUM, Words, list_column, ranges, shingles, whole

#: Text of benchmark items that one pass over the documents looks for, in bytes.
BLOCK_BYTES = 8 << 20

#: Rows of a batch that a task works on at a time.
STEP_ROWS = 1000

_FILTER_BITS = 22


@dataclass
class Vocabulary:
    """Shingles of a block of items, sorted by hash for each size; ids count through the sizes.

    A filter by the upper bits of the hash passes over most words of a text cheaply.
    """

    sizes: list[int]
    hashes: list[np.ndarray]
    first: list[int]
    maybe: list[np.ndarray]

    @staticmethod
    def of(by_size: dict[int, np.ndarray]) -> Vocabulary:
        sizes = sorted(by_size)
        hashes = [np.unique(by_size[s]) for s in sizes]
        first = [0, *np.cumsum([len(x) for x in hashes]).tolist()]
        maybe = []
        for x in hashes:
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[x >> np.uint64(64 - _FILTER_BITS)] = True
            maybe.append(seen)
        return Vocabulary(sizes, hashes, first, maybe)

    def ids(self, size: int, hashes: np.ndarray) -> np.ndarray:
        i = self.sizes.index(size)
        return self.first[i] + np.searchsorted(self.hashes[i], hashes)

    def find(self, i: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ``hashes`` has shingles of the i-th size, and which ones."""
        at = np.flatnonzero(self.maybe[i][hashes >> np.uint64(64 - _FILTER_BITS)])
        spot = np.searchsorted(self.hashes[i], hashes[at])
        known = self.hashes[i][np.minimum(spot, len(self.hashes[i]) - 1)] == hashes[at]
        return at[known], self.first[i] + spot[known]


@dataclass
class Windows:
    """Distinct windows. words: length of each. ids: its shingles in order, -1 after the last.
    items: of window w, ``items[item_at[w]:item_at[w + 1]]``."""

    words: np.ndarray
    ids: np.ndarray
    item_at: np.ndarray
    items: np.ndarray


def _windows(names: list[str], texts: pa.Array, window: int, shingle: int) -> tuple[Vocabulary, Windows]:
    words = Words(texts, NOT_ALNUM)
    found: dict[tuple[int, int], tuple[np.ndarray, int, set[str]]] = {}
    by_size: dict[int, list[np.ndarray]] = {}
    for name, a, b in zip(names, words.row, words.row[1:]):
        item = words.hash[a:b]
        length = min(window, len(item))
        if not length:
            continue
        size = min(shingle, length)
        parts = shingles(item, size)
        by_size.setdefault(size, []).append(parts)
        for start in range(len(item) - length + 1):
            held = parts[start : start + length - size + 1]
            found.setdefault((length, int(whole(held))), (held, size, set()))[2].add(name)
    vocabulary = Vocabulary.of({s: np.concatenate(x) for s, x in by_size.items()})
    wide = max((len(x) for x, _, _ in found.values()), default=1)
    ids = np.full((len(found), wide), -1)
    for row, (held, size, _) in zip(ids, found.values()):
        row[: len(held)] = vocabulary.ids(size, held)
    items = [sorted(x) for _, _, x in found.values()]
    at = np.cumsum([0, *map(len, items)])
    lengths = np.array([n for n, _ in found], np.int64)
    return vocabulary, Windows(lengths, ids, at, np.array([x for own in items for x in own], object))


def _stand(vocabulary: Vocabulary):
    """Per document: its words, and the places of shingles by size and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(a, STEP_ROWS) for x in batches for a in range(0, x.num_rows, STEP_ROWS)):
            words = Words(batch.column(1), NOT_ALNUM)
            rows, places, ids = [], [], []
            for i, size in enumerate(vocabulary.sizes):
                at, which = vocabulary.find(i, shingles(words.hash, size))
                row = np.searchsorted(words.row, at, "right") - 1
                inside = at + size <= words.row[row + 1]
                rows.append(row[inside])
                places.append((at - words.row[row])[inside])
                ids.append(which[inside])
            row, place, which = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, places, ids))
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(words.counts()),
                    list_column(place[order], ends, pa.int64()),
                    list_column(which[order], ends, pa.int64()),
                ],
                ["doc_id", "digest", "n_words", "places", "shingles"],
            )

    return run


def _verify(windows: Windows, rarest: np.ndarray, offset: np.ndarray, n_shingles: int):
    """Spans and items of each document. rarest: shingle that window w joins on, -1 for none."""
    joined = np.flatnonzero(rarest >= 0)
    joined = joined[np.argsort(rarest[joined], kind="stable")]
    first = np.searchsorted(rarest[joined], np.arange(n_shingles + 1))
    last_id = (windows.ids >= 0).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = batch.column("n_words").to_numpy()
            lists = batch.column("places")
            place = lists.flatten().to_numpy().astype(np.int64)
            which = batch.column("shingles").flatten().to_numpy().astype(np.int64)
            length = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), length)
            # Join: each place of a rarest shingle with the windows it may belong to.
            hits = first[which + 1] - first[which]
            spot = np.repeat(np.arange(len(which)), hits)
            window = joined[ranges(first[which], hits)]
            start = place[spot] - offset[window]
            # Length and positional bounds.
            fits = (start >= 0) & (start + windows.words[window] <= n_words[row[spot]])
            spot, window, start = spot[fits], window[fits], start[fits]
            # Exact check: the other shingles at their places. Places of one size lie in a row.
            base = spot - offset[window]
            good = base >= 0
            for j in range(windows.ids.shape[1]):
                asked = good & (j < last_id[window])
                at = np.clip(base + j, 0, max(len(which) - 1, 0))
                same = asked & (base + j < len(which))
                same[same] = (which[at[same]] == windows.ids[window[same], j]) & (row[at[same]] == row[spot[same]]) & (place[at[same]] == start[same] + j)
                good &= ~asked | same
            window, start, of = window[good], start[good], row[spot[good]]
            yield _spans(batch, windows, window, start, of)

    return run


def _spans(batch: pa.RecordBatch, windows: Windows, window, start, of) -> pa.RecordBatch:
    order = np.lexsort((start, of))
    window, start, of = window[order], start[order], of[order]
    end = start + windows.words[window]
    far = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(of * far + end) - of * far  # the furthest end so far, by document
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (start[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(of))[: len(heads)] - 1
    ends = np.searchsorted(of[heads], np.arange(batch.num_rows + 1))
    spans = pa.StructArray.from_arrays([pa.array(start[heads]), pa.array(reach[last])], ["from", "to"])
    spans = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spans)
    items: list[list[str]] = [[] for _ in range(batch.num_rows)]
    for d, a, b in zip(range(batch.num_rows), (at := np.searchsorted(of, np.arange(batch.num_rows + 1))), at[1:]):
        if a < b:
            items[d] = sorted({x for w in np.unique(window[a:b]) for x in windows.items[windows.item_at[w] : windows.item_at[w + 1]]})
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("digest"), batch.column("n_words"), spans, pa.array(items, pa.list_(pa.string()))],
        ["doc_id", "digest", "n_words", "spans", "items"],
    )


def benchmark_spans(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 10,
    shingle: int = 5,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` for every row of ``docs``.

    Words are runs of ASCII letters and digits, A-Z lower-cased, and of all other code points from
    0x80 up. ``spans`` are the stretches of words ``[from, to)`` inside occurrences of windows,
    merged and in order; ``items`` the ids, as strings in order, of items with such windows.

    A NULL or empty text has no words. Items without words have no windows, and a NULL item id is
    the empty string; items of equal text are all named, an id that repeats once. Equal rows of
    ``docs`` give equal rows. Empty tables give no rows or no spans. Other columns are ignored.
    """
    storage = Storage(docs.sparkSession, "decontaminate")
    asked = items.select(
        F.coalesce(column(items, item_key).cast("string"), F.lit("")).alias("item"), F.coalesce(column(items, item_text), F.lit("")).alias("text")
    )
    size = asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(column(docs, key).alias("doc_id"), column(docs, text).alias("text"), F.xxhash64(column(docs, text)).alias("digest"))
    kind = docs.schema[key].dataType.simpleString()
    found = []
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).toArrow()
        vocabulary, windows = _windows(block["item"].to_pylist(), block["text"].combine_chunks(), window, shingle)
        found.append(_block(rows, vocabulary, windows, kind, storage, b))
    if blocks == 1:
        return found[0].select("doc_id", "n_words", "spans", "items")
    # Documents that several blocks found something in; equal rows are counted, not merged.
    keys = ["doc_id", "digest", "n_words"]
    each = [x.groupBy(*keys).agg(F.count("*").alias("n"), F.first("spans").alias("s"), F.first("items").alias("i")) for x in found]
    union = each[0]
    for x in each[1:]:
        union = union.unionByName(x)
    union = union.groupBy(*keys).agg(
        F.max("n").alias("n"), F.array_sort(F.flatten(F.collect_list("s"))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("i")))).alias("items")
    )
    union = union.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return union.select("doc_id", "n_words", _merged("s").alias("spans"), "items")


def _block(rows: DataFrame, vocabulary: Vocabulary, windows: Windows, kind: str, storage: Storage, b: int) -> DataFrame:
    head = f"doc_id {kind}, digest long, n_words long"
    stand = storage.table(rows.mapInArrow(_stand(vocabulary), f"{head}, places array<long>, shingles array<long>"), f"places-{b}")
    n = vocabulary.first[-1]
    # One count per shingle of the block: as bounded as the block.
    counts = np.zeros(n, np.int64)
    for shingle, count in stand.select(F.explode("shingles").alias("s")).groupBy("s").count().collect():
        counts[shingle] = count
    rare = np.where(windows.ids >= 0, counts[windows.ids] if n else 0, np.iinfo(np.int64).max)
    offset = rare.argmin(1) if len(rare) else np.zeros(0, np.int64)
    rarest = windows.ids[np.arange(len(rare)), offset] if len(rare) else np.zeros(0, np.int64)
    if len(rare):
        rarest = np.where(rare.min(1) > 0, rarest, -1)
    return stand.mapInArrow(_verify(windows, rarest, offset, n), f"{head}, spans array<struct<from: long, to: long>>, items array<string>")


def _merged(spans: str):
    """Sorted spans without overlap; those that touch become one."""

    def add(done, x):
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["from"].alias("from"), F.greatest(last["to"], x["to"]).alias("to"))
        return F.when(x["from"] <= last["to"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    empty = F.array().cast("array<struct<from: bigint, to: bigint>>")
    return F.aggregate(spans, empty, add)


def decontaminated(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, as they are."""
    rows = docs.select(as_struct(docs, "doc"), column(docs, text).alias("words"), *row_hashes(docs, key, text))
    spans = benchmark_spans(rows.select("words", F.struct(*ROW).alias("row")), items, key="row", text="words", **options)
    found = spans.filter(F.size("spans") > 0).select(F.col("doc_id." + ROW[0]), F.col("doc_id." + ROW[1])).distinct()
    return rows.join(found, list(ROW), "left_anti").select("doc.*")
