"""Token ids in flat binary files, found by key through a minimal perfect hash (operator 2).

Documents in ascending key order are dealt into shards of about equal text. A shard is two files:

* ``payload/<shard>.ids``: all ids as little-endian unsigned integers, two bytes each if the
  vocabulary allows, else four; every document ends with the end id;
* ``payload/<shard>.end``: per document the number of ids up to its end, unsigned 64-bit.

The index maps a key to its shard and its place there. Keys fall into buckets by hash, and a bucket
is one row of the table ``index`` with a minimal perfect hash: per level a bit set of the places
that exactly one key hashed to, later levels for the keys that collided. The number of bits set
before a key's bit is its slot, which holds shard, place, number of copies and a fingerprint, by
which keys that were never stored are told. A look-up reads one bucket, a few bits and one slot.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelog.llm.storage import Storage, column, qualified
from tablelog.llm.words import mix, piece_hashes, ranges, text_bytes

#: Text of one shard, in bytes, and keys of one index bucket.
SHARD_BYTES = 8 << 20
BUCKET_KEYS = 2048
#: Text that a task encodes in one step.
STEP_BYTES = 1 << 20


@dataclass(frozen=True)
class TokenFiles:
    """path: the folder. width: bytes of an id. shards: table (shard, documents, ids, first_id).
    index: table (bucket, blob). buckets: their number."""

    path: str
    width: int
    buckets: int
    shards: DataFrame
    index: DataFrame


# --- encoding -----------------------------------------------------------------------------------


class Pieces:
    """Ids of pieces in the order in which these were learned, found by the hash of a piece.

    Those of piece i are ``ids[start[i] : start[i + 1]]``. ``slots`` holds 1 + i at the place that the upper
    bits of the hash name, or the next free one. New pieces are added behind the others, so that
    nothing is sorted or copied but when an array is full.
    """

    def __init__(self, kind: np.dtype):
        self.n = 0
        self.hashes = np.zeros(0, np.uint64)
        self.start = np.zeros(1, np.int64)
        self.ids = np.zeros(0, kind)
        self.slots = np.zeros(1 << 16, np.int32)

    def __len__(self) -> int:
        return self.n

    def _home(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 where it is not known."""
        out = np.full(len(hashes), -1, np.int64)
        rest, spot = np.arange(len(hashes) if self.n else 0), self._home(hashes)
        while len(rest):
            held = self.slots[spot]
            other = self.hashes[held - 1] != hashes[rest]  # free slots are sorted out below
            good = (held > 0) & ~other
            out[rest[good]] = held[good] - 1
            more = (held > 0) & other
            rest, spot = rest[more], (spot[more] + 1) % len(self.slots)
        return out

    def add(self, hashes: np.ndarray, size: np.ndarray, parts: list[np.ndarray]) -> None:
        """Pieces that are not known, each once, with all their ids in order."""
        n, at = self.n + len(hashes), int(self.start[self.n])
        self.hashes, self.start = _grown(self.hashes, n), _grown(self.start, n + 1)
        self.ids = _grown(self.ids, at + int(size.sum()))
        self.hashes[self.n : n] = hashes
        self.start[self.n + 1 : n + 1] = at + np.cumsum(size)
        for x in parts:
            self.ids[at : at + len(x)] = x
            at += len(x)
        first, self.n = self.n, n
        if 2 * n > len(self.slots):
            self.slots = np.zeros(1 << (2 * n).bit_length(), np.int32)
            first = 0
        self._seat(np.arange(first, n))

    def _seat(self, pieces: np.ndarray) -> None:
        spot = self._home(self.hashes[pieces])
        while len(pieces):
            free = self.slots[spot] == 0
            self.slots[spot[free]] = pieces[free] + 1  # one of several that want a slot has it
            left = self.slots[spot] != pieces + 1
            pieces, spot = pieces[left], (spot[left] + 1) % len(self.slots)

    def forget(self, n: int) -> None:
        """Keep the ``n`` pieces learned first, which are the frequent ones."""
        self.n = n
        self.slots[:] = 0
        self._seat(np.arange(n))


def _grown(held: np.ndarray, n: int) -> np.ndarray:
    """The array with room for ``n`` values."""
    if n <= len(held):
        return held
    out = np.empty(max(n, len(held) * 3 // 2), held.dtype)
    out[: len(held)] = held
    return out


class PieceEncoder:
    """The ids of Arrow texts, by way of pieces that the tokenizer never merges over.

    Byte-level BPE first cuts a text into words, and a piece is some of these in a row: cuts lie
    before a space or line end that a sign other than white space follows, and between an ASCII letter
    and an ASCII punctuation mark. Pieces are told apart by 64-bit hashes, found in numpy. Those not
    met before are encoded, many at a time with an empty line between, which is a token of its own;
    up to ``remembered`` of them are kept for later texts. The tokenizer finds its added tokens, such as
    ``<|endoftext|>``, before it cuts a text into words, so texts that hold the string of one are encoded
    whole. Tokenizers of other kinds, or without such a token, get whole texts.
    """

    GAP = "\n\n"

    def __init__(self, file: str, remembered: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        gap = self._ids(self.GAP)
        alone = len(gap) == 1 and self._ids(f" a{self.GAP} b") == [*self._ids(" a"), gap[0], *self._ids(" b")]
        added = [x for x in self.tokenizer.get_added_tokens_decoder().values() if x.content]
        self.added = "|".join(re.escape(x.content) for x in added)  # a pattern, empty if there are none
        # A normaliser may make the string of such a token from others, and one may hold the gap.
        plain = not any(self.GAP in x.content or (x.normalized and self.tokenizer.normalizer) for x in added)
        self.gap = gap[0] if alone and plain and '"ByteLevel"' in self.tokenizer.to_str() else None
        self.remembered = remembered
        self.known = Pieces(self.kind)

    @staticmethod
    def of_worker(file: str) -> PieceEncoder:
        """The encoder of this Python worker, which tasks after this one find again."""
        held = sys.modules.setdefault("_token_files_worker", types.ModuleType("_token_files_worker"))
        if file not in held.__dict__:
            held.__dict__[file] = PieceEncoder(file)
        return held.__dict__[file]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each row's begin (one more than rows)."""
        if self.gap is None:
            parts = self.direct(["" if x is None else x for x in column.to_pylist()])
            return np.concatenate([np.zeros(0, self.kind), *parts]), np.cumsum([0, *map(len, parts)])
        if not self.added or not pc.any(held := pc.match_substring_regex(column, self.added)).as_py():
            return self._by_pieces(column)
        held = pc.fill_null(held, False)
        ids, at = self._by_pieces(pc.if_else(held, pa.scalar("", column.type), column))
        parts, spots = self.direct(column.filter(held).to_pylist()), np.flatnonzero(held)
        size = np.diff(at)
        size[spots] = [len(x) for x in parts]
        return np.insert(ids, np.repeat(at[spots], size[spots]), np.concatenate(parts)), np.append(0, np.cumsum(size))

    def _by_pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, rows = text_bytes(column)
        start = np.flatnonzero(_cuts(data, rows))
        hashes = piece_hashes(data, start)
        place = self.known.find(hashes)
        new = np.flatnonzero(place < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            self._learn(data, start, hashes, new[first])
            place[new] = self.known.find(hashes[new])
        spot = self.known.start[place]
        size = self.known.start[place + 1] - spot
        ids = self.known.ids[ranges(spot, size)]
        at = np.append(0, np.cumsum(size))[np.searchsorted(start, rows)]
        if len(self.known) > 2 * self.remembered:
            self.known.forget(self.remembered)
        return ids, at

    def _learn(self, data: np.ndarray, start: np.ndarray, hashes: np.ndarray, new: np.ndarray) -> None:
        ends = np.append(start[1:], len(data))
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(start[new].tolist(), ends[new].tolist())]
        # Between empty lines stand pieces that begin with one white space and do not end with any.
        joined = np.array([x[0] in " \n" and not x[1:2].isspace() and not x[-1].isspace() and self.GAP not in x for x in texts])
        parts: list = [None] * len(texts)
        for a in range(0, len(spots := np.flatnonzero(joined)), 4096):
            some = spots[a : a + 4096]
            ids = np.array(self._ids(self.GAP.join([texts[i] for i in some])), self.kind)
            cut = np.flatnonzero(ids == self.gap)
            if len(cut) != len(some) - 1:  # another token has the gap's id
                joined[some] = False
                continue
            for i, x, y in zip(some, [0, *(cut + 1)], [*cut, len(ids)]):
                parts[i] = ids[x:y]
        rest = np.flatnonzero(~joined)
        for i, x in zip(rest, self.direct([texts[i] for i in rest])):
            parts[i] = x
        self.known.add(hashes[new], np.array([len(x) for x in parts], np.int64), parts)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # white space beyond ASCII begins with one of these
_BREAK = np.zeros(256, bool)
_BREAK[[10, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _cuts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte."""
    out = np.zeros(len(data), bool)
    if len(data):
        out[:-1] = _BREAK[data[:-1]] & ~_SPACE[data[1:]]
        out[rows[1:] - 1] = False  # the next byte is another row's
        out[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
        out[rows[:-1][rows[:-1] < len(data)]] = True
    return out


# --- minimal perfect hash -------------------------------------------------------------------------


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h1 ^ mix(h2 + np.uint64(level))) % np.uint64(size)).astype(np.int64)


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, their bits as 64-bit words, and the slot of every key."""
    rest, sizes, bits, level_of, at = np.arange(len(h1)), [], [], np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
    base = 0
    while len(rest):
        if len(sizes) > 64:
            raise ValueError("two keys have the same hashes")
        size = -(-2 * len(rest) // 64) * 64
        place = _place(h1[rest], h2[rest], len(sizes), size)
        alone = np.bincount(place, minlength=size)[place] == 1
        level = np.zeros(size, np.uint8)
        level[place[alone]] = 1
        at[rest[alone]] = base + place[alone]
        level_of[rest[alone]] = len(sizes)
        bits.append(level)
        sizes.append(size)
        base += size
        rest = rest[~alone]
    flat = np.concatenate(bits) if bits else np.zeros(0, np.uint8)
    slot = (np.cumsum(flat) - 1)[at] if len(flat) else at
    return sizes, np.packbits(flat, bitorder="little").view(np.uint64), slot


class PerfectIndex:
    """The index of one bucket: ``pack`` makes its bytes, ``find`` looks keys up in them."""

    FIELDS = (("print", np.uint32), ("shard", np.uint32), ("place", np.uint64), ("copies", np.uint32))

    @staticmethod
    def pack(h1: np.ndarray, h2: np.ndarray, shard, place, copies) -> bytes:
        sizes, words, slot = build_hash(h1, h2)
        parts = [np.array([len(sizes), len(h1), *sizes], np.uint64), words]
        for (_, kind), values in zip(PerfectIndex.FIELDS, (h2 >> np.uint64(32), shard, place, copies), strict=True):
            held = np.zeros(len(h1), kind)
            held[slot] = values
            parts.append(held)
        return b"".join(x.tobytes() for x in parts)

    def __init__(self, blob: bytes):
        levels, n = (int(x) for x in np.frombuffer(blob, np.uint64, 2))
        self.sizes = [int(x) for x in np.frombuffer(blob, np.uint64, levels, 16)]
        at = 16 + 8 * levels
        self.words = np.frombuffer(blob, np.uint64, sum(self.sizes) // 64, at)
        at += self.words.nbytes
        for name, kind in self.FIELDS:
            setattr(self, name, np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 for keys that are not stored."""
        slot, rest, base = np.full(len(h1), -1), np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(h1[rest], h2[rest], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[rest[here]] = (self.before[at >> 6] + below)[here]
            rest, base = rest[~here], base + size
        known = slot >= 0
        known[known] = self.print[slot[known]] == (h2[known] >> np.uint64(32)).astype(np.uint32)
        return np.where(known, slot, -1)


def _hashes(key: str):
    return F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2")


# --- files ----------------------------------------------------------------------------------------


def _files(path: str):
    """The file system and path that ``path`` names, as Spark qualified it; a plain path is a local one."""
    from pyarrow import fs

    path = re.sub(r"^file:/*", "/", path)
    path = re.sub(r"^s3[an]://", "s3://", path)  # Hadoop's names of the same store
    return fs.FileSystem.from_uri(path if re.match(r"\w+://", path) else f"file://{os.path.abspath(path)}")


def _put(fs, path: str, write) -> None:
    """Write a file under another name and rename it, so that no reader meets half of one."""
    part = f"{path}.{os.getpid()}-{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(part) as out:
        write(out)
    fs.move(part, path)


def write_token_files(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> TokenFiles:
    """Encode every whole text and write shards and index below ``path``.

    ``tokenizer`` is the path of a tokenizers file that every executor has. A NULL text is empty and
    has the end id alone. NULL keys come first and are a key like others. Rows with one key are all
    stored, next to each other by the hash of their text; such a group lies in one shard. Ids are those of
    the library's ``encode(text, add_special_tokens=False)``: the string ``<|endoftext|>`` in a text is
    the token of that name. An empty table gives empty tables. Other columns
    are ignored. Shards are written whole and renamed; a task that runs again writes the same bytes.
    """
    spark = docs.sparkSession
    storage = Storage(spark, "token-files")
    path = qualified(spark, path)
    rows = docs.select(column(docs, key).alias("key"), F.coalesce(column(docs, text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-size // shard_bytes))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, F.col("key").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("key").asc_nulls_first(), "tie").select("key", "text")
    key_type = docs.schema[key].dataType
    fields = f"key {key_type.simpleString()}, shard long, place long, ids long"
    write = _shard_writer(f"{path}/payload", tokenizer, end_id)
    entries = storage.table(rows.mapInArrow(write, fields), "entries")

    shards = entries.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first_id")
    shards.select("shard", "documents", "ids", first).write.mode("overwrite").parquet(f"{path}/shards")

    buckets = max(1, -(-entries.count() // BUCKET_KEYS))
    spots = entries.groupBy("key").agg(F.min(F.struct("shard", "place")).alias("at"), F.count("*").alias("copies"))
    spots = spots.select(*_hashes("key"), "at.shard", "at.place", "copies")
    index = spots.groupBy(F.pmod("h1", F.lit(buckets)).alias("bucket")).applyInPandas(_index_bucket, "bucket long, blob binary")
    index.write.mode("overwrite").parquet(f"{path}/index")
    storage.drop("entries")
    return open_token_files(spark, path, PieceEncoder(tokenizer).kind.itemsize, buckets)


def open_token_files(spark: SparkSession, path: str, width: int, buckets: int) -> TokenFiles:
    path = qualified(spark, path)
    shards = spark.read.schema("shard long, documents long, ids long, first_id long").parquet(f"{path}/shards")
    return TokenFiles(path, width, buckets, shards, spark.read.schema("bucket long, blob binary").parquet(f"{path}/index"))


def _shard_writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _files(folder)
        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker had
        encoder = PieceEncoder.of_worker(tokenizer)
        shard = TaskContext.get().partitionId()
        fs.create_dir(root, recursive=True)
        lengths: list[np.ndarray] = []
        keys: list[pa.Array] = []

        def payload(out) -> None:
            for batch in batches:
                for texts in _steps(batch.column(1)):
                    ids, at = encoder.encode(texts)
                    lengths.append(np.diff(at) + 1)
                    out.write(np.insert(ids, at[1:], end_id).tobytes())
                keys.append(batch.column(0))

        first = next(batches, None)
        if first is None:
            return
        batches = _again(first, batches)
        _put(fs, f"{root}/{shard:08d}.ids", payload)
        counts = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        _put(fs, f"{root}/{shard:08d}.end", lambda out: out.write(np.cumsum(counts).astype("<u8").tobytes()))
        at = 0
        for x in keys:
            n = len(x)
            yield pa.RecordBatch.from_arrays(
                [x, pa.array(np.full(n, shard)), pa.array(np.arange(at, at + n)), pa.array(counts[at : at + n])],
                ["key", "shard", "place", "ids"],
            )
            at += n

    return write


def _steps(texts: pa.Array) -> Iterator[pa.Array]:
    """Some texts at a time, by their bytes."""
    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < len(texts):
        before = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, before + STEP_BYTES, "right")))
        yield texts.slice(a, b - a)
        a = b


def _again(first, rest):
    yield first
    yield from rest


def _index_bucket(bucket: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = (rows[x].to_numpy(np.int64).view(np.uint64) for x in ("h1", "h2"))
    blob = PerfectIndex.pack(h1, h2, rows["shard"], rows["place"], rows["copies"])
    return pd.DataFrame({"bucket": [bucket[0]], "blob": [blob]})


def locate(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """Where the documents of ``keys(key)`` are: (key, shard, place, copies), absent keys left out.

    A key that comes up several times is found as often.
    """
    fields = f"key {keys.schema['key'].dataType.simpleString()}, shard long, place long, copies long"
    asked = keys.select("key", *_hashes("key"))
    asked = asked.withColumn("bucket", F.pmod("h1", F.lit(files.buckets)))
    pairs = asked.groupBy("bucket").cogroup(files.index.groupBy("bucket"))
    return pairs.applyInArrow(_look_up, fields)


def _look_up(asked: pa.Table, index: pa.Table) -> pa.Table:
    if not len(asked) or not len(index):
        slot, held = np.full(len(asked), -1), None
    else:
        held = PerfectIndex(index["blob"][0].as_py())
        slot = held.find(*(asked[x].to_numpy().view(np.uint64) for x in ("h1", "h2")))
    known = slot >= 0
    found = [getattr(held, x)[slot[known]].astype(np.int64) if held else np.zeros(0, np.int64) for x in ("shard", "place", "copies")]
    return pa.table([asked["key"].filter(pa.array(known)), *map(pa.array, found)], ["key", "shard", "place", "copies"])


def read_documents(files: TokenFiles, keys: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """Documents read from the files by key: (key, start, n_tokens, ids_crc32[, ids]).

    ``start`` counts the ids of all documents before this one; ``ids_crc32`` is over all its ids as
    little-endian unsigned 32-bit integers. Each asked key gives all documents stored under it. Rows
    are dealt by place, so that a task reads stretches of few shards in their order.
    """
    spots = locate(files, keys)
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = spots.repartitionByRange(n, "shard", "place").sortWithinPartitions("shard", "place")
    kind = keys.schema["key"].dataType.simpleString()
    fields = f"key {kind}, shard long, offset long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    found = spots.mapInArrow(_reader(f"{files.path}/payload", files.width, with_ids), fields)
    found = found.join(files.shards.select("shard", "first_id"), "shard")
    more = ["ids"] if with_ids else []
    return found.select("key", (F.col("first_id") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *more)


def _reader(folder: str, width: int, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _files(folder)
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            edges = [*np.flatnonzero(np.diff(shards, prepend=-1)), len(shards)]
            for a, b in zip(edges, edges[1:]):
                name = f"{root}/{shards[a]:08d}"
                with fs.open_input_file(f"{name}.end") as f:
                    ends = np.frombuffer(f.read(), "<u8").astype(np.int64)
                with fs.open_input_file(f"{name}.ids") as f:
                    yield _documents(f, batch.slice(a, b - a), ends, width, with_ids)

    return read


def _documents(file, rows: pa.RecordBatch, ends: np.ndarray, width: int, with_ids: bool) -> pa.RecordBatch:
    copies = rows.column("copies").to_numpy()
    places = ranges(rows.column("place").to_numpy(), copies)
    begins = np.append(0, ends[:-1])
    crc, ids = [], []
    for p in places:
        a, b = int(begins[p]), int(ends[p])
        file.seek(a * width)
        wide = np.frombuffer(file.read((b - a) * width), f"<u{width}").astype("<u4")
        crc.append(zlib.crc32(wide.tobytes()))
        if with_ids:
            ids.append(wide.astype(np.int64))
    again = pa.array(np.repeat(np.arange(len(copies)), copies))
    out = {"key": rows.column("key").take(again), "shard": rows.column("shard").take(again), "offset": pa.array(begins[places])}
    out |= {"n_tokens": pa.array(ends[places] - begins[places]), "ids_crc32": pa.array(crc, pa.int64())}
    if with_ids:
        out["ids"] = pa.array(ids, pa.list_(pa.int64()))
    return pa.RecordBatch.from_pydict(out)
