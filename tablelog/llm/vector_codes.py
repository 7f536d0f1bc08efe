"""Vectors as short codes: a codebook for each part, learned by ball k-means on integers (operator 12).

A vector's components become integers and its parts are assigned to the nearest entry of their
codebook, with exact distances. From the second round on a part starts from the entry that it had.
The ball of an entry reaches to the farthest of its parts, and only entries within twice that radius
are its neighbours. A part whose distance is under half the way to the nearest of them lies in the
stable core and stays without a search. The others lie in rings between half the ways to one
neighbour and the next, and are compared with the neighbours up to their ring. By the triangle
inequality no other entry is as near, so the codes are those of a full search.

Tasks send the sums of the parts of each entry with the rows that they write; these are added up
in a fixed number of tasks. The codebooks are all that the driver holds.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelog.llm.storage import Storage, column

#: Vectors that a task searches together.
BLOCK = 1 << 15
#: Labels up to this many are sent to all tasks; more of them are joined by a shuffle.
BROADCAST_LABELS = 1 << 16


@dataclass(frozen=True)
class VectorCodes:
    """rows: (vec_id, label, code, error). codebooks: entries x width integers of each part."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def sha256(self) -> str:
        """Hex digest of all entries' components, by part, entry and place, between commas."""
        flat = (str(int(x)) for book in self.codebooks for x in book.ravel())
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def greatest(dims: int) -> int:
    """Components up to this size give distances that are exact in double precision."""
    return math.isqrt(2**53 // max(dims, 1)) // 2 - 1


# --- assignment -------------------------------------------------------------------------------------


def _squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(1)


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part, the lowest of equally near ones, and its squared distance."""
    d = _squared(x, centers)
    code = d.argmin(1)
    return code, d[np.arange(len(x)), code]


class Balls:
    """The entries of one codebook, and for each the others by distance."""

    def __init__(self, centers: np.ndarray):
        self.centers = centers
        gaps = _squared(centers, centers)
        np.fill_diagonal(gaps, -1)  # an entry comes before its equals
        self.order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.order, 1)

    def nearest_from(self, x: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``nearest``, where every part had the entry ``old``."""
        own = ((x - self.centers[old]) ** 2).sum(1)
        code, best = old.copy(), own.copy()
        by_entry = np.argsort(old, kind="stable")
        edge = np.flatnonzero(np.diff(old[by_entry], prepend=-1))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(by_entry)]):
            ball = by_entry[a:b]
            entry = int(old[ball[0]])
            radius = own[ball].max()
            neighbours = self.order[entry, : np.searchsorted(self.gaps[entry], 4 * radius, "right")]
            # An entry as far as twice a part's distance may tie with its own, so it counts as inside.
            ring = np.searchsorted(self.gaps[entry, : len(neighbours)], 4 * own[ball], "right")
            inner = 0
            while inner < len(neighbours):  # rings of twice as many neighbours each
                outer = min(len(neighbours), max(4, 2 * inner))
                some = ball[(ring > inner) & (ring <= outer)]
                if len(some):
                    self._search(x, some, neighbours[:outer], code, best)
                inner = outer
        return code, best

    def _search(self, x, some, candidates, code, best) -> None:
        d = _squared(x[some], self.centers[candidates])
        least = np.minimum(d.min(1), best[some])
        found = np.where(d == least[:, None], candidates, len(self.centers)).min(1)
        code[some] = np.minimum(found, np.where(best[some] == least, code[some], len(self.centers)))
        best[some] = least


def assign(x: np.ndarray, codebooks: list[np.ndarray], old: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The code of every vector, a column for each part, and the sum of its squared distances."""
    width = codebooks[0].shape[1]
    codes, error = np.empty((len(x), len(codebooks)), np.int64), np.zeros(len(x))
    for p, centers in enumerate(codebooks):
        part = x[:, p * width : (p + 1) * width]
        book = centers.astype(np.float64)
        codes[:, p], d = nearest(part, book) if old is None else Balls(book).nearest_from(part, old[:, p])
        error += d
    return codes, error.astype(np.int64)


# --- tasks --------------------------------------------------------------------------------------------


def _integers(scale: int):
    """Rows with their vectors as little-endian integers; others are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").cast(pa.large_list(pa.float64()))
            filled = vectors.is_valid().to_numpy(zero_copy_only=False)
            size = np.diff(vectors.offsets.to_numpy()) * filled
            vectors = vectors.filter(pa.array(filled))
            flat = vectors.flatten()
            values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            whole = np.floor(values * scale)
            # Distances of longer vectors, and of greater components, would not be exact.
            most = np.repeat(np.array([greatest(d) for d in size[filled]]), size[filled])
            bad = ~(np.abs(whole) <= most)
            at = np.append(0, np.cumsum(size[filled]))
            bad_before = np.append(0, np.cumsum(bad))
            good = (bad_before[at[1:]] == bad_before[at[:-1]]) & (size[filled] > 0)
            data = np.where(bad, 0, whole).astype("<i4").tobytes()
            kept = np.flatnonzero(filled)[good]
            spans = zip(at[:-1][good].tolist(), at[1:][good].tolist())
            out = batch.select(["vec_id", "label"]).take(pa.array(kept))
            rest = [pa.array(size[kept].astype(np.int32)), pa.array([data[4 * a : 4 * b] for a, b in spans], pa.binary())]
            yield pa.RecordBatch.from_arrays([*out.columns, *rest], ["vec_id", "label", "dims", "v"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def _matrix(blobs: pa.Array, kind: str, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), kind).reshape(len(blobs), dims)


def _round(codebooks: list[np.ndarray], dims: int):
    """Rows with their codes, and per task one row with the sums and counts of all entries."""
    parts, (entries, width) = len(codebooks), codebooks[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, kinds = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64), None
        for block in _blocks(batches):
            kinds = block.schema
            x = _matrix(block.column("v"), "<i4", dims).astype(np.float64)
            known = block.column("code").null_count == 0
            old = _matrix(block.column("code"), np.uint8, parts).astype(np.int64) if known else None
            codes, _ = assign(x, codebooks, old)
            for p in range(parts):
                counts[p] += np.bincount(codes[:, p], minlength=entries)
                for i in range(width):  # sums of integers, exact in double precision for one block
                    sums[p, :, i] += np.bincount(codes[:, p], x[:, p * width + i], entries).astype(np.int64)
            raw = codes.astype(np.uint8).tobytes()
            out = [block.column(c) for c in ("vec_id", "label", "v")]
            out.append(pa.array([raw[a : a + parts] for a in range(0, len(raw), parts)], pa.binary()))
            out.append(pa.nulls(len(codes), pa.binary()))
            yield pa.RecordBatch.from_arrays(out, ["vec_id", "label", "v", "code", "sums"])
        if kinds is not None:
            blob = pa.array([sums.tobytes() + counts.tobytes()], pa.binary())
            empty = [pa.nulls(1, kinds.field(c).type) for c in ("vec_id", "label", "v", "code")]
            yield pa.RecordBatch.from_arrays([*empty, blob], ["vec_id", "label", "v", "code", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for blob in batch.column("sums").to_pylist():
            one = np.frombuffer(blob, np.int64)
            total = one.copy() if total is None else total + one
    if total is not None:
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})


def _coded(codebooks: list[np.ndarray], dims: int):
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            old = _matrix(block.column("code"), np.uint8, parts).astype(np.int64) if block.column("code").null_count == 0 else None
            codes, error = assign(_matrix(block.column("v"), "<i4", dims).astype(np.float64), codebooks, old)
            raw = codes.astype(np.uint8).tobytes()
            code = pa.array([raw[a : a + parts] for a in range(0, len(raw), parts)], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("label"), code, pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def compress_vectors(
    vectors: DataFrame,
    *,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> VectorCodes:
    """Codes of all kept vectors, one byte for each part, and the codebooks.

    Left out are vectors that are NULL or empty, hold NULL or non-finite components, have another
    length than most (the shorter of equally frequent lengths counts) or one that ``parts`` does not
    divide, or hold a component so great (over 5,000 at 64 components) that distances would not be exact.
    Codebooks start as the parts of the ``entries`` smallest keys (NULL keys last, equal keys by their
    vectors). Equal rows all count and are all returned. An empty table gives no rows and no codebooks.
    Other columns are ignored. ``entries`` is 256 at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"a code has one byte for each part, so entries must be 1 to 256, not {entries}")
    spark = vectors.sparkSession
    storage = Storage(spark, "vector-codes")
    rows = vectors.select(column(vectors, key).alias("vec_id"), column(vectors, label).alias("label"), column(vectors, vector).alias("vector"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    rows = storage.table(rows.mapInArrow(_integers(scale), f"{kinds}, dims int, v binary"), "integers")
    lengths = rows.filter(F.col("dims") % parts == 0).groupBy("dims").count()
    most = lengths.orderBy(F.desc("count"), "dims").limit(1).collect()
    if not most:
        return VectorCodes(spark.createDataFrame([], f"{kinds}, code binary, error long"), [])
    dims = most[0]["dims"]
    rows = rows.filter(F.col("dims") == dims).select("vec_id", "label", "v", F.lit(None).cast("binary").alias("code"))
    # Ties by the components as numbers would need them as a list; any order of equal keys by content does.
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), F.hex("v")).limit(entries).select("v").collect()  # 256 rows at most
    seeds = np.array([np.frombuffer(r["v"], "<i4") for r in seeds], np.int64)
    width = dims // parts
    books = [seeds[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    for turn in range(rounds):
        done = rows.mapInArrow(_round(books, dims), f"{kinds}, v binary, code binary, sums binary")
        done = storage.table(done, f"round-{turn}")
        storage.drop(f"round-{turn - 1}" if turn else "integers")
        sums = done.filter(F.col("sums").isNotNull()).select("sums").repartition(16).mapInArrow(_added, "sums binary").collect()  # 16 rows at most
        total = sum(np.frombuffer(r["sums"], np.int64) for r in sums)
        added, counts = np.split(total, [parts * len(seeds) * width])
        added, counts = added.reshape(parts, len(seeds), width), counts.reshape(parts, len(seeds), 1)
        books = [np.where(n > 0, s // np.maximum(n, 1), book) for s, n, book in zip(added, counts, books)]
        rows = done.filter(F.col("sums").isNull()).select("vec_id", "label", "v", "code")
    out = storage.table(rows.mapInArrow(_coded(books, dims), f"{kinds}, code binary, error long"), "codes")
    storage.drop(f"round-{rounds - 1}" if rounds else "integers")
    return VectorCodes(out, books)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``, the sum of ``error`` over their label; NULL labels count as one."""
    known = F.coalesce("label", F.lit(0).cast(rows.schema["label"].dataType)), F.col("label").isNull()
    rows = rows.withColumns({"label_value": known[0], "label_null": known[1]})
    sums = rows.groupBy("label_value", "label_null").agg(F.sum("error").alias("label_error"))
    sums = Storage(rows.sparkSession, "label-errors").table(sums, "sums")
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return rows.join(sums, ["label_value", "label_null"]).drop("label_value", "label_null")
