"""Nearly equal lines by MinHash, one line of each group kept (operator 3).

1. Every line with a word has a signature: all its character shingles are hashed, and of 64 ranges of
   hashes each gives its least. Five ranges are a band; lines that agree in a band are candidates,
   which those of Jaccard similarity 0.8 are with a probability of about 0.995 (0.9998 at 0.87). Lines
   of 15 to 60 shingles have 32 ranges in two orders of the hashes and 16 bands of four (0.9998), those
   of 8 to 22 half as many (0.996); short ones are candidates if all their shingles, or all but one,
   agree, which no pair of 0.8 fails.
2. Equal lines are one line from here on. A sketch of each has a bit for every hash of its shingles, turned
   over by each shingle: two sketches differ in no more bits than the sets in shingles, so lines whose
   sketches differ in too many cannot be near. In each band entry all lines are paired with the least
   one, in a large one with some more; pairs that may be near are verified by the exact Jaccard similarity of all their character
   shingles, and linked lines form components.
3. Lines of different components that share a band entry and may be near are paired and verified as
   well. The pairs of an entry are looked through in memory and only those leave a task that sketches
   and sizes allow, so no link is left out, and templates with many fillings and lines with a long
   passage in common make few pairs. An entry of very many lines is dealt to many tasks.
4. Union-find gives the groups. The first line of each, by document and place, is kept.

Shingles are hashed, sorted and compared in numpy (the native form did not meet the limits, see the
README); joins, counts and union-find are Spark's. Tables that have served are dropped, and entries are
sent in as many passes as keep what is on disk at once in proportion to the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelog.llm.components import components, with_more_links
from tablelog.llm.storage import ROW, Storage, column, row_hashes
from tablelog.llm.words import list_column, mix, piece_hashes, ranges, text_bytes

#: Characters of a shingle.
SHINGLE = 5
#: Signatures of lines with so many shingles: ranges as a power of two, ranges of a band, orders of the hashes.
#: Lines of Jaccard similarity 0.8 have keys of one kind: with ten shingles or more in their union
#: both have eight, with fewer both have nine or less, and two sizes of different kinds alone differ
#: by more than a quarter.
SIGNATURES = (((48, 1 << 40), 6, 5, 1), ((15, 60), 5, 4, 2), ((8, 22), 4, 4, 2))
#: Shingles of a short line at most.
SHORT = 9
#: Text that a task works on in one step.
STEP_BYTES = 1 << 17
#: Keys of one bucket, whose least lines a task finds together, and keys in one row that is sent there.
BUCKET_KEYS = 1 << 21
ROW_KEYS = 128
#: Bits of the filter of keys that two lines have, as a power of two: 16 MB in each task.
FILTER_BITS = 27
#: Bits of a sketch at least; long lines have a power of two that is one and a half times their shingles or more.
SKETCH_BITS = 512
#: Lines of an entry that one task compares; a larger one is dealt out in blocks of so many, BLOCK at least.
SMALL_ENTRY = 1 << 14
BLOCK = 64
#: Lines of an entry that has centres besides its least line; centres of a line, centres in a row without lines,
#: and lines that one without a centre is paired with.
CROWD = 64
CENTRES, IDLE_CENTRES, NEAREST = 4, 16, 2
#: Rows of entries sent in one pass: for each line, and at least.
PASS_SHARE = 2
PASS_ROWS = 1 << 20
#: Rows and bytes that a task compares in one step, if entries end there; lines that one line is compared with by itself.
COMPARED_ROWS, COMPARED_BYTES = 1 << 16, 1 << 24
MANY = 256

_WORD = r"[^\x20\x09-\x0D]"
_LOW = np.uint64((1 << 40) - 1)
_KEPT = np.uint64(24)
_rng = np.random.Generator(np.random.PCG64(20240307))
_PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TURN = np.uint64(0x9E3779B97F4A7C15)


# --- lines and shingles -------------------------------------------------------------------------------


class Lines:
    """Lines with a word of some texts. row, place: which. start, end: in bytes."""

    def __init__(self, texts: pa.Array):
        self.data, rows = text_bytes(texts)
        breaks = np.flatnonzero(self.data == 10)
        start = np.concatenate([rows[:-1], breaks + 1])
        row = np.concatenate([np.arange(len(rows) - 1), np.searchsorted(rows, breaks, "right") - 1])
        order = np.lexsort((start, row))
        start, row = start[order], row[order]
        last = np.append(row[1:] != row[:-1], True)
        end = np.where(last, rows[row + 1], np.append(start[1:], 0) - 1)
        place = np.arange(len(row)) - np.searchsorted(row, row)
        blank = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        words = np.append(0, np.cumsum(~blank))
        kept = words[end] > words[start]
        self.row, self.place, self.start, self.end = row[kept], place[kept], start[kept], end[kept]

    def ids(self) -> np.ndarray:
        """A hash of the bytes of each line."""
        data, ends = self._bytes(slice(None))
        return piece_hashes(data, ends[:-1]).view(np.int64)

    def texts(self, some: np.ndarray) -> pa.Array:
        data, ends = self._bytes(some)
        return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())]).cast(pa.string())

    def _bytes(self, some) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.start[some], self.end[some]
        return self.data[ranges(a, b - a)], np.append(0, np.cumsum(b - a)).astype(np.int64)

    def shingles(self, some: slice) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles of some lines with repeats, and the number of each line's."""
        start, end = self.start[some], self.end[some]
        a, b = (int(start[0]), int(end[-1])) if len(start) else (0, 0)
        chars, before = _characters(self.data[a:b])
        start = before[start - a]
        length = before[end - a] - start
        total = len(chars)
        chars = np.append(chars, np.zeros(SHINGLE, np.uint64))
        sums = np.zeros(total, np.uint64)
        for j in range(SHINGLE):
            sums += chars[j : j + total] * _PLACE[j]
        size = np.maximum(length - SHINGLE + 1, 1)
        first = np.cumsum(size) - size
        found = sums[ranges(start, size)]
        for n in range(1, SHINGLE):  # a line shorter than a shingle is one, told from others by its length
            some_lines = np.flatnonzero(length == n)
            at = start[some_lines]
            found[first[some_lines]] = sum(chars[at + j] * _PLACE[j] for j in range(n)) + mix(np.full(1, n, np.uint64))
        return _spread(found), size


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each character as the number that its bytes make, and the characters before each byte and the end."""
    lead = (data & 0xC0) != 0x80
    if lead.all():
        return data.astype(np.uint64), np.arange(len(data) + 1)
    at = np.flatnonzero(lead)  # first bytes of characters
    size = np.diff(np.append(at, len(data)))
    chars = data[at].astype(np.uint64)
    for j in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > j)
        chars[more] = (chars[more] << np.uint64(8)) | data[at[more] + j]
    return chars, np.append(0, np.cumsum(lead))


def _spread(sums: np.ndarray) -> np.ndarray:
    """Sums with random factors, which tell shingles apart, in an order that has nothing of theirs."""
    sums ^= sums >> np.uint64(32)
    sums *= _TURN
    sums ^= sums >> np.uint64(29)
    sums *= np.uint64(0xBF58476D1CE4E5B9)
    return sums


def _steps(line: Lines) -> Iterator[slice]:
    """Some lines at a time, by their bytes."""
    total = np.cumsum(line.end - line.start)
    a = 0
    while a < len(total):
        before = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, before + STEP_BYTES, "right")))
        yield slice(a, b)
        a = b


def _distinct(hashes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line number and upper 40 bits of the hash, each distinct one once, in order; how many each line has."""
    line = np.repeat(np.arange(len(size), dtype=np.uint64), size)
    both = np.sort((line << np.uint64(40)) | (hashes >> np.uint64(24)))
    held = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    return held, np.bincount((held >> np.uint64(40)).astype(np.int64), minlength=len(size))


def _bands(held: np.ndarray, bits: int, width: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of every band of ``width`` ranges that has a shingle."""
    of = held >> np.uint64(40 - bits)
    least = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    of = of[least]
    line, band = (of >> np.uint64(bits)).astype(np.int64), (of & np.uint64((1 << bits) - 1)) // np.uint64(width)
    first = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (band[1:] != band[:-1])))
    sums = np.add.reduceat(mix((held[least] & _LOW) * _TURN), first)
    tag = np.uint64(1 + (order << 8 | bits) << 8) + band[first]
    return line[first], mix(sums ^ mix(tag))


def keys(held: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of all keys of lines with so many distinct shingles each, as ``_distinct`` has them.

    The least hashes of all ranges are cut into bands, which are keys; where there are two orders of the
    hashes the same is done in the second. Of a short line all shingles are a key, and all but any
    one. Lines near a border of these have keys of both kinds.
    """
    line = (held >> np.uint64(40)).astype(np.int64)
    found = []
    for (low, high), bits, width, orders in SIGNATURES:
        mine = held[((n >= low) & (n <= high))[line]]
        for order in range(orders if len(mine) else 0):
            turned = np.sort((mine & ~_LOW) | (mix(mine & _LOW) >> _KEPT)) if order else mine
            found.append(_bands(turned, bits, width, order))
    short = np.flatnonzero(n[line] <= SHORT)
    if len(short):
        value, of = mix(held[short] & _LOW), line[short]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        sums = np.add.reduceat(value, first)
        found.append((of[first], mix(sums)))
        # With fewer than five shingles only equal sets are as near as 0.8.
        some = n[of] > 4
        found.append((of[some], mix(np.repeat(sums, n[of[first]]) - value)[some]))
    lines, values = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return lines, values


def _text_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Lines]]:
    """Some rows at a time, by the bytes of their texts."""
    for batch in batches:
        total = np.cumsum(batch.column("size").to_numpy())
        a = 0
        while a < batch.num_rows:
            before = total[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(total, before + STEP_BYTES, "right")))
            yield batch.slice(a, b - a), Lines(batch.column("text").slice(a, b - a))
            a = b


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with a word, with its keys, number of shingles and sketch."""
    for rows, lines in _text_steps(batches):
        ids = lines.ids()
        for some in _steps(lines):
            held, n = _distinct(*lines.shingles(some))
            of, values = keys(held, n)
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(len(n) + 1))
            own = pa.array(lines.row[some])
            columns = [pa.array(ids[some]), *(rows.column(c).take(own) for c in ("doc_id", *ROW))]
            columns += [pa.array(lines.place[some].astype(np.int32)), pa.array(n.astype(np.int32))]
            columns += [_sketches(held, n), list_column(values[order].view(np.int64), ends, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "doc_id", *ROW, "place", "n", "sketch", "bands"])


def _wanted_lines(flags, bits: int):
    """The texts of lines whose id meets a bit of the filter, each once in a step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(flags.value, np.uint8)
        for _, lines in _text_steps(batches):
            ids = lines.ids()
            kept = np.flatnonzero(_meets(held, ids, bits))
            _, first = np.unique(ids[kept], return_index=True)
            kept = kept[first]
            yield pa.RecordBatch.from_arrays([pa.array(ids[kept]), lines.texts(kept)], ["id", "line"])

    return run


def _meets(held: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    place = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (held[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


# --- band entries -------------------------------------------------------------------------------------

_SENT = "bucket long, bands binary, ids binary"


def _blobs(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * values.itemsize).astype(np.int32)), pa.py_buffer(values.tobytes())])


def _numbers(column: pa.Array, a: int, b: int, kind: str) -> np.ndarray:
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset + a : column.offset + b + 1]
    return np.frombuffer(column.buffers()[2], kind, (at[-1] - at[0]) // np.dtype(kind).itemsize, at[0])


def _sent(buckets: int):
    """Keys with their lines, many of one bucket in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("bands")
            values = bands.flatten().to_numpy().view(np.uint64)
            if not len(values):
                continue
            times = np.diff(bands.offsets.to_numpy())
            ids = np.repeat(batch.column("id").to_numpy(), times)
            bucket = (((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = -(-np.diff(np.append(first, len(bucket))) // ROW_KEYS)
            edges = np.append(np.repeat(first, rows) + ROW_KEYS * ranges(np.zeros(len(rows), np.int64), rows), len(bucket))
            blobs = [_blobs(x[order], edges) for x in (values, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(bucket[first], rows)), *blobs], ["bucket", "bands", "ids"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that two lines have, with these lines. One row of each key has their number, the others 0.
    A task holds one row per key of a bucket."""

    def rows(bands: np.ndarray, ids: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bands.view(np.int64)), pa.array(ids), pa.array(count)], ["band", "id", "lines"])

    def settled(held: list) -> tuple[list, pa.RecordBatch]:
        bands, ids, count = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(bands, kind="stable")
        bands, ids, count = bands[order], ids[order], count[order]
        new = np.append(True, bands[1:] != bands[:-1])
        first = np.flatnonzero(new)
        more = rows(bands[~new], ids[~new], np.zeros(len(bands) - len(first), np.int64))
        return [(bands[first], ids[first], np.add.reduceat(count, first))], more

    def done(held: list) -> Iterator[pa.RecordBatch]:
        [(bands, ids, count)], more = settled(held)
        two = count > 1
        yield more
        yield rows(bands[two], ids[two], count[two])

    bucket, held, size, limit = None, [], 0, BUCKET_KEYS
    for batch in batches:
        own = batch.column("bucket").to_numpy()
        edges = np.flatnonzero(np.append(True, np.diff(own) != 0))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)]):
            if own[a] != bucket and held:
                yield from done(held)
                held, size, limit = [], 0, BUCKET_KEYS
            bucket = own[a]
            bands = _numbers(batch.column("bands"), a, b, "<u8")
            held.append((bands, _numbers(batch.column("ids"), a, b, "<i8"), np.ones(len(bands), np.int64)))
            size += len(bands)
            if size >= limit:
                held, more = settled(held)
                yield more
                size = len(held[0][0])
                limit = max(BUCKET_KEYS, 2 * size)
    if held:
        yield from done(held)


def _filter(spark, hashes: DataFrame, bits: int):
    """The bits of all hashes in the one column, put together on the executors in 64 stretches of fixed size."""
    stretch = 1 << bits - 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            for s in np.unique(place // stretch).tolist():
                held.setdefault(s, np.zeros(stretch, bool))[place[place // stretch == s] - s * stretch] = True
        for s, flags in held.items():
            yield pa.RecordBatch.from_pydict({"stretch": pa.array([s]), "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    places = hashes.select(F.shiftrightunsigned(hashes.columns[0], 64 - bits).alias("place")).distinct()
    out = np.zeros((64, stretch // 8), np.uint8)
    for r in places.repartition(64, F.floor(F.col("place") / stretch)).mapInArrow(run, "stretch long, bits binary").collect():  # 64 rows of fixed size
        out[r["stretch"]] = np.frombuffer(r["bits"], np.uint8)
    return spark.sparkContext.broadcast(out.tobytes())


# --- sketches and pairs -------------------------------------------------------------------------------


def _sketches(held: np.ndarray, n: np.ndarray) -> pa.Array:
    """The sketches of lines, from line number and 40 bits of the hash of all distinct shingles, in order.
    A smaller sketch is a larger one whose parts are laid over each other."""
    line = (held >> np.uint64(40)).astype(np.int64)
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(1.5 * np.maximum(n, 1))).astype(np.int64))
    ends = np.append(0, np.cumsum(bits))
    place = (held & _LOW).astype(np.int64) & (bits - 1)[line]
    place += ends[line]
    first = np.append(0, np.cumsum(n))
    parts, a = [np.zeros(0, np.uint8)], 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + (1 << 20), "right")) - 1)
        times = np.bincount(place[first[a] : first[b]] - ends[a], minlength=ends[b] - ends[a])
        parts.append(np.packbits((times & 1).astype(bool), bitorder="little"))
        a = b
    return _blobs(np.concatenate(parts), ends // 8)


def _words(sketches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of 64 bits of all sketches, and where each begins (one more than sketches)."""
    at = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset : sketches.offset + len(sketches) + 1].astype(np.int64)
    return _numbers(sketches, 0, len(sketches), "<u8"), (at - at[0]) // 8


def _laid(data: np.ndarray, at: np.ndarray, some: np.ndarray, width: int) -> np.ndarray:
    """The sketches of some lines in so many words, which none has less of."""
    out = np.empty((len(some), width), np.uint64)
    words = (at[1:] - at[:-1])[some]
    for w in np.unique(words).tolist():
        mine = np.flatnonzero(words == w)
        parts = data[at[some[mine]][:, None] + np.arange(w)].reshape(len(mine), w // width, width)
        out[mine] = np.bitwise_xor.reduce(parts, axis=1)
    return out


def _allowed(off: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can agree to ``percent`` if sketches differ in ``off`` bits. Sets differ in as
    many shingles at least, but for one that 40 bits of the hash may hide."""
    return (100 + percent) * (off.astype(np.int64) - 1) <= (100 - percent) * (n + m)


def _centred(sketch: np.ndarray, n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of lines of one entry that are likely to be near: each line that none is near so far is a centre, and
    is paired with others that have few centres yet; lines that get none are paired with those most like
    them. Where a group has no line that is near all others, this leaves few of it in other components;
    it may leave some."""
    bits = 64 * sketch.shape[1]
    seen, times, idle, out = np.zeros(len(n), bool), np.zeros(len(n), np.int64), 0, [(np.zeros(0, np.int64),) * 2]
    while idle < IDLE_CENTRES and not seen.all():
        centre = int(np.argmin(seen))
        off = np.bitwise_count(sketch ^ sketch[centre]).sum(1, dtype=np.int64)
        # Bits that shingles have turned back are added by their expected number.
        differ = -0.5 * bits * np.log1p(-2 * np.minimum(off, bits // 2 - 1) / bits)
        near = (2 * off < bits) & ((100 + percent) * differ <= (100 - percent) * (n + n[centre]))
        seen[centre], near[centre] = True, False
        seen |= near
        y = np.flatnonzero(near & (times < CENTRES))
        times[y] += 1
        idle = 0 if len(y) else idle + 1
        out.append((np.full(len(y), centre), y))
    alone = np.ones(len(n), bool)
    for x in out:
        alone[np.concatenate(x)] = False
    for i in np.flatnonzero(alone).tolist():
        off = np.bitwise_count(sketch ^ sketch[i]).sum(1, dtype=np.int64)
        may = _allowed(off, n, n[i], percent)
        may[i] = False
        y = np.flatnonzero(may)
        y = y[np.argsort(off[y] / (n[y] + n[i]), kind="stable")[:NEAREST]]
        out.append((np.full(len(y), i), y))
    return tuple(np.concatenate(x) for x in zip(*out))


def _stars(percent: int):
    """Of entries in order of keys and lines, the pairs of the least line and each other that may be near, and in
    large ones those of some more centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.concat_batches([last, batch])
            band, ids, n = (batch.column(c).to_numpy() for c in ("band", "id", "n"))
            n = n.astype(np.int64)
            data, at = _words(batch.column("sketch"))
            first = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
            head = np.repeat(first, np.diff(np.append(first, len(band))))
            y = np.flatnonzero((ids != ids[head]) & (100 * np.minimum(n, n[head]) >= percent * np.maximum(n, n[head])))
            x = head[y]
            near = np.zeros(len(y), bool)
            width = np.minimum(np.diff(at)[x], np.diff(at)[y])
            for w in np.unique(width).tolist():
                of = np.flatnonzero(width == w)
                for a in range(0, len(of), COMPARED_ROWS):
                    i, j = x[of[a : a + COMPARED_ROWS]], y[of[a : a + COMPARED_ROWS]]
                    off = np.bitwise_count(_laid(data, at, i, w) ^ _laid(data, at, j, w)).sum(1, dtype=np.int64)
                    near[of[a : a + COMPARED_ROWS]] = _allowed(off, n[i], n[j], percent)
            yield pa.RecordBatch.from_arrays([pa.array(ids[x[near]]), pa.array(ids[y[near]])], ["a", "b"])
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(band)]):
                if b - a > CROWD:
                    x, y = _centred(_laid(data, at, np.arange(a, b), int(np.diff(at)[a:b].min())), n[a:b], percent)
                    x, y = ids[a + x], ids[a + y]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
            last = batch.slice(int(first[-1]), 1)

    return run


def _near_in(entries: pa.RecordBatch, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of lines that may be near, in one entry but different components. Rows are in
    order of entries and sizes."""
    key, n, component = (entries.column(c).to_numpy() for c in ("key", "n", "component"))
    n = n.astype(np.int64)
    data, at = _words(entries.column("sketch"))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    mixed = np.minimum.reduceat(component, first) < np.maximum.reduceat(component, first)
    entry = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
    rows = np.flatnonzero(mixed[entry])
    words = np.diff(at)
    for w in np.unique(words[rows]).tolist():
        # Sets of w words have 64 w shingles at most; a pair is found with its smaller sketch.
        some = rows[(words[rows] >= w) & (percent * n[rows] <= 6400 * w)]
        size, of = n[some], component[some]
        sketch = _laid(data, at, some, w)
        order = entry[some] * (size.max() + 1) + size
        most = np.minimum(100 * size // percent, size.max()) if percent else np.full(len(size), size.max())
        end = np.searchsorted(order, order - size + most, "right")
        many = end - np.arange(len(some)) - 1
        many[words[some] != w] = 0
        few = np.flatnonzero((many > 0) & (many <= MANY))
        total = np.append(0, np.cumsum(many[few]))
        a = 0
        while a < len(few):
            b = max(a + 1, int(np.searchsorted(total, total[a] + COMPARED_ROWS, "right")) - 1)
            x, y = np.repeat(few[a:b], many[few[a:b]]), ranges(few[a:b] + 1, many[few[a:b]])
            a = b
            apart = of[x] != of[y]
            x, y = x[apart], y[apart]
            off = np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)
            near = _allowed(off, size[x], size[y], percent)
            yield some[x[near]], some[y[near]]
        long = np.flatnonzero(many > MANY).tolist()
        turned = np.ascontiguousarray(sketch.T) if long else sketch
        for i in long:
            others = slice(i + 1, int(end[i]))
            off = np.bitwise_count(turned[:, others] ^ turned[:, i : i + 1]).sum(0, dtype=np.int64)
            near = np.flatnonzero(_allowed(off, size[others], size[i], percent) & (of[others] != of[i])) + i + 1
            if len(near):
                yield some[np.full(len(near), i)], some[near]


def _mixed_pairs(percent: int):
    """The pairs of ``_near_in``, the smaller id first. A task holds an entry."""

    def pairs(entries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = entries.column("id").to_numpy()
        found, size = [], 0
        for x, y in _near_in(entries, percent):
            found.append((np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])))
            size += len(x)
            if size >= COMPARED_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])
                found, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, turns = [], 0, 0, 1
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= turns * COMPARED_ROWS or size >= turns * COMPARED_BYTES:
                whole = pa.concat_batches(held)
                key = whole.column("key").to_numpy()
                last = int(np.flatnonzero(np.append(True, key[1:] != key[:-1]))[-1])
                if last:
                    yield from pairs(whole.slice(0, last))
                whole = whole.slice(last)
                held, rows, size = [whole], whole.num_rows, whole.nbytes
                turns = 1 if last else 2 * turns
        if held:
            yield from pairs(pa.concat_batches(held))

    return run


# --- verification -------------------------------------------------------------------------------------


def _sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of all distinct shingles, in order."""
    lines = Lines(texts)
    # Lines hold a word and no line end, so they are the texts.
    hashes, size = lines.shingles(slice(0, len(lines.start)))
    of = np.repeat(lines.row, size)
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.append(True, (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1]))[: len(of)]
    return of[new], hashes[new]


def _overlap(x: pa.Array, y: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in common and in all of each pair of texts, exactly."""
    (p, a), (q, b) = _sets(x), _sets(y)
    of, both = np.concatenate([p, q]), np.concatenate([a, b])
    order = np.lexsort((both, of))
    of, both = of[order], both[order]
    twice = (of[1:] == of[:-1]) & (both[1:] == both[:-1])
    common = np.bincount(of[1:][twice], minlength=len(x))
    return common, np.bincount(of, minlength=len(x)) - common


def _near_overlap(x: pa.Array, y: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same by 40 bits of the hashes, in one sort: an equal pair of bits is rarely off by one."""
    sides = []
    for texts in (x, y):
        lines = Lines(texts)
        sides.append(_distinct(*lines.shingles(slice(0, len(lines.start))))[0])
    both = np.sort(np.concatenate(sides))
    of = (both >> np.uint64(40)).astype(np.int64)
    common = np.bincount(of[1:][both[1:] == both[:-1]], minlength=len(x))
    return common, np.bincount(of, minlength=len(x)) - common


#: Shingles that 40 bits of all hashes of a pair may be wrong by. More has a chance of 10 ** -18 or so.
_OFF = 3


def _near(percent: int):
    """The pairs whose shingles agree to ``percent``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(pc.add(pc.binary_length(batch.column("x")), pc.binary_length(batch.column("y"))).to_numpy())
            a = 0
            while a < batch.num_rows:
                before = size[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(size, before + STEP_BYTES, "right")))
                some = batch.slice(a, b - a)
                a = b
                x, y = some.column("x"), some.column("y")
                common, union = _near_overlap(x, y)
                good = 100 * common >= percent * union
                close = np.flatnonzero(np.abs(100 * common - percent * union) <= (100 + percent) * _OFF)
                if len(close):
                    common, union = _overlap(x.take(pa.array(close)), y.take(pa.array(close)))
                    good[close] = 100 * common >= percent * union
                yield some.select(["a", "b"]).filter(pa.array(good))

    return run


def _verified(pairs: DataFrame, rows: DataFrame, percent: int, storage: Storage, name: str) -> DataFrame:
    """The pairs that are near, as a table. Texts of the lines in pairs come from another look at the documents."""
    ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b"))
    asked = storage.table(ends.distinct(), f"{name}-asked", clean=True)
    flags = _filter(pairs.sparkSession, asked, FILTER_BITS)
    texts = rows.select("text", "size").mapInArrow(_wanted_lines(flags, FILTER_BITS), "id long, line string")
    texts = texts.dropDuplicates(["id"]).join(asked, "id", "left_semi")
    texts = storage.table(texts, f"{name}-texts", clean=True)
    flags.unpersist()
    side = lambda end, line: texts.select(F.col("id").alias(end), F.col("line").alias(line))
    full = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    out = storage.table(full.select("a", "b", "x", "y").mapInArrow(_near(percent), "a long, b long"), name, clean=True)
    storage.drop(f"{name}-texts")
    storage.drop(f"{name}-asked")
    return out


def _spots(lines: DataFrame, columns: list[str], turn: int, passes: int) -> DataFrame:
    """Lines by their keys, of those keys whose turn it is."""
    due = F.filter("bands", lambda x: F.pmod(x, F.lit(passes)) == turn) if passes > 1 else F.col("bands")
    return lines.select(*columns, F.explode(due).alias("band"))


def _first_pairs(lines: DataFrame, percent: int, storage: Storage, passes: int) -> DataFrame:
    """Pairs of the least line of each entry and another one that may be near, as a table."""
    out = []
    for turn in range(passes):
        spots = _spots(lines, ["id", "n", "sketch"], turn, passes).repartition("band").sortWithinPartitions("band", "id")
        out.append(storage.table(spots.mapInArrow(_stars(percent), "a long, b long"), f"pairs-{turn}", clean=True))
    pairs = storage.table(_together(out).distinct(), "pairs", clean=True)
    for turn in range(passes):
        storage.drop(f"pairs-{turn}")
    return pairs


def _together(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for x in tables[1:]:
        out = out.unionByName(x)
    return out


def _across(named: DataFrame, large: DataFrame, percent: int, storage: Storage, passes: int = 1) -> DataFrame:
    """Pairs of lines that may be near, in one entry but different components. named: lines with their
    component and keys. large: ``(band, lines)`` of the entries that are dealt out in blocks."""
    blocks = None
    if not large.isEmpty():
        # Two blocks meet in one task each; of entries with one component nothing is sent.
        held = named.select("component", F.explode("bands").alias("band")).join(large, "band")
        held = held.groupBy("band").agg((F.min("component") < F.max("component")).alias("mixed"), F.max("lines").alias("lines"))
        count = F.ceil(F.col("lines") / max(SMALL_ENTRY, BLOCK))
        blocks = storage.table(held.select("band", F.when(F.col("mixed"), count).otherwise(F.lit(0)).cast("long").alias("blocks")), "blocks", clean=True)
    out = []
    for turn in range(passes):
        spots = _spots(named, ["id", "n", "component", "sketch"], turn, passes)
        if blocks is None:
            spots = spots.withColumnRenamed("band", "key")
        else:
            spots = spots.join(blocks, "band", "left").filter("blocks is null or blocks > 0")
            own, other = F.pmod(F.xxhash64("id"), F.col("blocks")), F.col("other")
            others = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
            key = F.when(F.col("blocks").isNull(), F.col("band")).otherwise(F.xxhash64("band", F.least(own, other), F.greatest(own, other)))
            spots = spots.withColumn("other", F.explode(others)).select("id", "n", "component", "sketch", key.alias("key"))
        spots = spots.repartition("key").sortWithinPartitions("key", "n")
        out.append(storage.table(spots.mapInArrow(_mixed_pairs(percent), "a long, b long"), f"across-{turn}", clean=True))
    return _together(out).distinct()


def line_groups(docs: DataFrame, *, percent: int = 80, key: str = "doc_id", text: str = "text", storage: Storage | None = None) -> DataFrame:
    """``(id, group, *ROW, doc_id, place, times)``: every distinct line with a word, its group, and where
    it first stands. Lines are ordered by key, NULL last, then by place in the text."""
    spark = docs.sparkSession
    storage = storage or Storage(spark, "fuzzy-lines")
    whole = F.coalesce(column(docs, text), F.lit(""))
    rows = docs.select(column(docs, key).alias("doc_id"), *row_hashes(docs, key, text), whole.alias("text"), F.octet_length(whole).cast("long").alias("size"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = f"{', '.join(f'{x} long' for x in ROW)}, place int, n int, sketch binary, bands array<long>"
    lines = rows.mapInArrow(_line_rows, f"id long, doc_id {kind}, {parts}")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *ROW, "place", "n", "sketch", "bands")
    found = lines.groupBy("id").agg(F.min(order).alias("at"), F.count("*").alias("times"))
    signed = found.select("id", "at.doc_id", *[f"at.{x}" for x in (*ROW, "place", "n", "sketch", "bands")], "times")
    signed = storage.table(signed, "signed", clean=True)

    total, distinct = signed.agg(F.sum(F.size("bands")), F.count("*")).first()
    buckets = max(1, -(-(total or 0) // BUCKET_KEYS))
    sent = signed.select("id", "bands").mapInArrow(_sent(buckets), _SENT)
    sent = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    entries = storage.table(sent.mapInArrow(_shared, "band long, id long, lines long"), "entries", clean=True)
    passes = max(1, -(-entries.count() // max(PASS_SHARE * distinct, PASS_ROWS)))
    large = storage.table(entries.filter(F.col("lines") > SMALL_ENTRY).select("band", "lines"), "large")

    # From here on keys and sketches of lines in entries only.
    asked = entries.groupBy("id").agg(F.collect_set("band").alias("bands"))
    lines = storage.table(signed.select("id", "n", "sketch").join(asked, "id"), "sketches", clean=True)
    found = storage.table(signed.drop("n", "sketch", "bands"), "lines")
    storage.drop("signed")
    storage.drop("entries")

    pairs = _first_pairs(lines, percent, storage, passes)
    links = _verified(pairs, rows, percent, storage, "links")
    groups = components(links, storage, "first-stars")
    storage.drop("links")
    named = lines.join(groups, F.col("id") == F.col("node"), "left")
    named = named.select("id", "n", "sketch", "bands", F.coalesce("component", "id").alias("component"))
    named = storage.table(named, "named", clean=True)
    storage.drop("sketches")
    more = _across(named, large, percent, storage, passes).join(pairs, ["a", "b"], "left_anti")
    more = storage.table(more, "more-pairs", clean=True)
    for name in ("pairs", "named", "large", "blocks", *(f"across-{turn}" for turn in range(passes))):
        storage.drop(name)
    if not more.isEmpty():
        links = _verified(more, rows, percent, storage, "more-links")
        groups = with_more_links(groups, links, storage, "more-stars")
        storage.drop("more-links")
    storage.drop("more-pairs")
    out = found.join(groups, F.col("id") == F.col("node"), "left")
    return out.select("id", F.coalesce("component", "id").alias("group"), *ROW, "doc_id", "place", "times")


def kept_lines(docs: DataFrame, *, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_lines, kept)`` for every row of ``docs``: lines with a word, and places of those kept.

    Of each group the first line stays, by key and place; of several equal rows of ``docs`` the lines
    of one stay. Lines without a word take no part and are neither counted nor listed. A NULL or empty
    text has no lines. Lines are told apart by 64-bit hashes. An empty table gives no rows; other
    columns are ignored.
    """
    groups = line_groups(docs, percent=percent, key=key, text=text)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *ROW, "place")).alias("first")
    kept = groups.groupBy("group").agg(first).groupBy(*[F.col(f"first.{x}").alias(x) for x in ROW])
    kept = kept.agg(F.sort_array(F.collect_list("first.place")).alias("kept"))
    lines = F.size(F.filter(F.split(F.coalesce(column(docs, text), F.lit("")), "\n", -1), lambda x: x.rlike(_WORD))).cast("long")
    rows = docs.select(column(docs, key).alias("doc_id"), lines.alias("n_lines"), *row_hashes(docs, key, text))
    # Equal rows: the first in any order keeps the lines, the others keep none.
    none = F.array().cast("array<int>")
    again = rows.groupBy("doc_id", "n_lines", *ROW).agg(F.count("*").alias("n")).join(kept, list(ROW), "left")
    turn = again.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return turn.select("doc_id", "n_lines", F.when(F.col("turn") == 1, F.coalesce("kept", none)).otherwise(none).alias("kept"))
