"""Documents of nearly equal word shingles, by token-combination prefixes (operator 7).

A document's set has its distinct shingles of ``k`` words as 64-bit hashes. Two sets link when
``100 * intersection >= percent * union``. A set of n tokens can then lack at most
``t = n * (100 - percent) // 100`` tokens in its partner.

Tokens are ordered rare first, then by hash, and fall into classes: a rare token is a class of its
own kind, frequent tokens fall into groups by hash. A set's prefix is extended until

    rare tokens in it + sum over groups of max(0, tokens of the group in it - 1) > t.

Whichever t tokens a partner lacks, either a rare token or two tokens of one group remain. Of two
linked sets the one whose prefix ends first has these in the other's prefix, too. So it is enough to
index single tokens for the rare class and pairs of tokens for each frequent group. There are about
as many groups as 1/32 of a set's size, so a set has few pairs in each; sizes are rounded to powers
of two, and a set near the border of two is indexed for both.

Sets that share an index entry are candidates if their lengths allow a link, and if the rare tokens
that they share are enough: of the set whose prefix ends first all other indexed rare tokens are
missing in its partner. Entries of rare tokens have fewer than ``frequent`` sets by definition. An
entry of a pair may have any number; there the set with the fewest rare tokens is compared with all
others first, components are formed, and only sets of different components are compared further.
All candidates are verified by exact intersection.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelog.llm.components import components, with_more_links
from tablelog.llm.storage import ROW, Storage, as_struct, column, row_hashes
from tablelog.llm.words import SPACE, Words, list_column, mix, ranges, shingles, whole

#: Documents from which on a token is frequent.
FREQUENT = 16
#: Bits of the filters that go to all tasks: 8 MB each, whatever the input. Fewer than needed let
#: through more candidates and never lose one.
FILTER_BITS = 26
#: Tokens that a task sorts at a time, and tokens of one bucket of the count.
FLUSH = 1 << 20
BUCKET_TOKENS = 1 << 21
#: Rows of a batch that a task works on at a time.
STEP_ROWS = 400
#: Sets of an index entry up to which all its pairs are compared at once.
SMALL = 32


def token_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct tokens of each row, and where each row's begin (one more than rows).

    A row of fewer than ``k`` words, but not none, has its whole sequence as the only token.
    """
    words = Words(texts, SPACE)
    counts = words.counts()
    long, short = np.maximum(counts - k + 1, 0), (counts > 0) & (counts < k)
    parts = shingles(words.hash, k)
    n = long + short
    at = np.concatenate([[0], np.cumsum(n)])
    flat = np.empty(at[-1], np.uint64)
    flat[ranges(at[:-1], long)] = parts[ranges(words.row[:-1], long)]
    for r in np.flatnonzero(short):
        flat[at[r]] = whole(words.hash[words.row[r] : words.row[r + 1]])
    for a, b in zip(at.tolist(), at[1:].tolist()):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[at[:-1][n > 0]] = True
    return flat[new], np.concatenate([[0], np.cumsum(new)])[at]


def set_ids(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every set."""
    raw, edges = flat.view(np.uint8), (at * 8).tolist()
    digests = [hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(edges, edges[1:])]
    return np.frombuffer(b"".join(digests), np.int64)


# --- filters of fixed size ------------------------------------------------------------------------


def _bit(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)


def _in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bit(hashes)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _assemble(parts: DataFrame) -> np.ndarray:
    """Stretches ``(at, bits)`` of a filter as one array of its fixed size."""
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for at, bits in parts.collect():
        out[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _stretch(first: int, size: int, set_bits: np.ndarray) -> pa.Table:
    held = np.zeros(size, bool)
    held[(set_bits - first).astype(np.int64)] = True
    return pa.table({"at": [first >> 3], "bits": [np.packbits(held, bitorder="little").tobytes()]})


def filter_of(hashes: DataFrame) -> np.ndarray:
    """A filter that holds every value of the long column ``hash``."""
    size = 1 << 16
    low = FILTER_BITS - 16

    def stretch(key: tuple, rows: pa.Table) -> pa.Table:
        first = int(key[0].as_py()) << 16
        return _stretch(first, size, np.unique(_bit(rows["hash"].to_numpy())).astype(np.int64))

    bucket = F.shiftrightunsigned("hash", 64 - low).alias("bucket")
    return _assemble(hashes.select("hash", bucket).groupBy("bucket").applyInArrow(stretch, "at long, bits binary"))


def frequent_filter(rows: DataFrame, k: int, frequent: int, bytes_of_text: int) -> np.ndarray:
    """A filter of the tokens that ``frequent`` or more rows of ``rows(text)`` hold.

    Tasks sort their tokens, cut them by the upper bits into buckets and send each bucket as the
    steps between 40-bit values, a step of 0 for each repetition. The buckets' number follows the
    input, so that one fits in a task.
    """
    bits = min(FILTER_BITS - 3, max(6, int(bytes_of_text // 5 // BUCKET_TOKENS).bit_length()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for a in range(0, batch.num_rows, STEP_ROWS):
                held.append(token_sets(batch.column(0).slice(a, STEP_ROWS), k)[0])
                if sum(map(len, held)) >= FLUSH:
                    yield send(held)
                    held = []
        if held:
            yield send(held)

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.sort(np.concatenate(held) >> np.uint64(24))
        edges = np.searchsorted(tokens, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(40 - bits))
        out: dict[str, list] = {"bucket": [], "first": [], "steps": []}
        for b in np.flatnonzero(np.diff(edges)):
            own = tokens[edges[b] : edges[b + 1]]
            steps = np.diff(own)
            wide = steps >> np.uint64(32) != 0
            for part in np.split(own, np.flatnonzero(wide) + 1) if wide.any() else [own]:
                out["bucket"].append(int(b))
                out["first"].append(int(part[0]))
                out["steps"].append(np.diff(part).astype("<u4").tobytes())
        return pa.RecordBatch.from_pydict(out, pa.schema([("bucket", pa.int64()), ("first", pa.int64()), ("steps", pa.binary())]))

    def count(key: tuple, parts: pa.Table) -> pa.Table:
        values = [
            np.cumsum(np.concatenate([[first], np.frombuffer(steps, "<u4")]).astype(np.uint64))
            for first, steps in zip(parts["first"].to_pylist(), parts["steps"].to_pylist())
        ]
        values = np.sort(np.concatenate(values))
        often = values[frequent - 1 :][values[frequent - 1 :] == values[: len(values) - frequent + 1]] if len(values) >= frequent else values[:0]
        size = 1 << (FILTER_BITS - bits)
        return _stretch(int(key[0].as_py()) * size, size, np.unique(often >> np.uint64(40 - FILTER_BITS)).astype(np.int64))

    sent = rows.select("text").mapInArrow(cut, "bucket long, first long, steps binary")
    return _assemble(sent.groupBy("bucket").applyInArrow(count, "at long, bits binary"))


# --- prefixes -------------------------------------------------------------------------------------


def _pair_entry(a: np.ndarray, b: np.ndarray, tag: int) -> np.ndarray:
    return mix(a + mix(b + np.uint64(tag)))


def prefix_entries(tokens: np.ndarray, often: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of one set: single rare tokens, and pairs of frequent ones."""
    n = len(tokens)
    need = n * (100 - percent) // 100 + 1
    rare = tokens[~often]
    if len(rare) >= need:
        return rare[:need], rare[:0]
    common, entries = tokens[often], []
    for tag in {(n * percent // 100 or 1).bit_length(), (n * 100 // percent).bit_length()}:
        groups = max(1, (1 << tag) // 64)
        group = (common & np.uint64(0xFFFF)).astype(np.int64) % groups
        order = np.argsort(group, kind="stable")
        head = np.ones(len(common), bool)
        head[order[1:]] = group[order[1:]] != group[order[:-1]]  # the first of its group in the order of tokens
        enough = len(rare) + np.cumsum(~head) >= need
        upto = int(enough.argmax()) + 1 if enough.any() else len(common)
        group, held = group[:upto], common[:upto]
        order = np.argsort(group, kind="stable")
        group, held = group[order], held[order]
        step = 1
        while step < len(held):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            entries.append(_pair_entry(held[:-step][same], held[step:][same], tag))
            step += 1
    return rare, np.concatenate(entries) if entries else rare[:0]


def _prefixes(often, k: int, percent: int):
    """Per document: set id, size, rare tokens (all if the set has pairs), entries, row hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = often.value
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                flat, at = token_sets(part.column(1), k)
                frequent = _in_filter(bits, flat)
                singles, pairs, rare = [], [], []
                for a, b in zip(at.tolist(), at[1:].tolist()):
                    one, two = prefix_entries(flat[a:b], frequent[a:b], percent) if b > a else (flat[:0], flat[:0])
                    singles.append(one)
                    pairs.append(two)
                    rare.append(len(one))
                columns = [part.column(0), pa.array(set_ids(flat, at)), pa.array(np.diff(at)), pa.array(rare, pa.int64())]
                for x in (singles, pairs):
                    ends = np.concatenate([[0], np.cumsum([len(y) for y in x])])
                    columns.append(list_column(np.concatenate(x).view(np.int64), ends, pa.int64()))
                names = ["doc_id", "set", "n", "rare", "singles", "pairs", *ROW]
                yield pa.RecordBatch.from_arrays([*columns, part.column(2), part.column(3)], names)

    return run


# --- candidates -----------------------------------------------------------------------------------


def _sizes_allow(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def _rare_allow(n, r, m, s, percent: int) -> np.ndarray:
    """Whether sets of n and m tokens may link though r and s of these are in one of them only."""
    most = np.minimum(n - r, m - s)
    return 100 * most >= percent * np.maximum(n + m - most, np.maximum(n + s, m + r))


def _entry_pairs(percent: int, small: int):
    """Pairs of sets from rows sorted by (entry, rare, set); a task holds ``small`` rows of an entry.

    The rows of a larger entry beyond these are paired with its first row only. Such an entry also
    gives a row that pairs a set with itself, with the entry's number in the last column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pool = None, np.zeros((0, 3), np.int64)
        for batch in batches:
            entry, two, ids, n, rare = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("entry", "two", "set", "n", "rare"))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(entry)) + 1, [len(entry)]])
            out: list[np.ndarray] = []
            # Entries of one row that neither begin nor end the batch pair nothing.
            busy = np.flatnonzero((np.diff(edges) > 1) | (np.arange(len(edges) - 1) == 0) | (np.arange(len(edges) - 1) == len(edges) - 2))
            for i in busy:
                a, b = edges[i], edges[i + 1]
                rows = np.stack([ids[a:b], n[a:b], rare[a:b]], 1)
                if entry[a] != last:
                    last, pool = entry[a], rows[:0]
                kept = len(pool)
                if kept < small:
                    pool = np.concatenate([pool, rows[: small - kept]])
                    x, y = np.triu_indices(len(pool), 1)
                    new = y >= kept
                    out.append(_checked(pool[x[new]], pool[y[new]], two[a], percent))
                rest = rows[max(0, small - kept) :]
                if len(rest):
                    out.append(_checked(np.repeat(pool[:1], len(rest), 0), rest, two[a], percent))
                    out.append(np.array([[pool[0, 0], pool[0, 0], 0, 0, 0, 0, entry[a]]]))
            found = np.concatenate(out) if out else np.zeros((0, 7), np.int64)
            columns = [pa.array(np.ascontiguousarray(x)) for x in found.T]
            yield pa.RecordBatch.from_arrays(columns, _FOUND)

    return run


_FOUND = ["a", "b", "n", "r", "m", "s", "single"]


def _checked(x: np.ndarray, y: np.ndarray, two: bool, percent: int) -> np.ndarray:
    """The pairs that sizes, and in entries of pairs the rare tokens, allow; smaller set first.

    Columns are ``_FOUND``: sets, tokens and rare entries of each, and 1 in an entry of one token.
    """
    good = _sizes_allow(x[:, 1], y[:, 1], percent)
    if two:
        good &= _rare_allow(x[:, 1], x[:, 2], y[:, 1], y[:, 2], percent)
    x, y = x[good], y[good]
    turned = (x[:, 0] > y[:, 0])[:, None]
    low, high = np.where(turned, y, x), np.where(turned, x, y)
    single = np.full((len(x), 1), int(not two))
    return np.concatenate([low[:, :1], high[:, :1], low[:, 1:], high[:, 1:], single], 1)


def _enough_shared(percent: int):
    """Whether ``c`` common rare entries are enough for a link of sets of n and m tokens.

    r and s rare tokens of these are indexed, all there are in a set that is ``full``. A set that is
    not full ends its prefix before one that is; of two others either may end first.
    """
    n, r, m, s, c = (F.col(x) for x in ("n", "r", "m", "s", "c"))
    full = lambda n, r: r < F.floor(n * (100 - percent) / 100) + 1
    by_a, by_b = n - r + c, m - s + c
    most = F.when(full(n, r) & full(m, s), F.least(by_a, by_b)).when(full(n, r), by_b).when(full(m, s), by_a)
    most = F.least(most.otherwise(F.greatest(by_a, by_b)), n, m)
    return 100 * most >= percent * (n + m - most)


# --- verification ---------------------------------------------------------------------------------


def _tokens_of(wanted, k: int):
    """(set, tokens) of the documents whose set id the filter holds, once in a task however many are equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        sent: set[int] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                flat, at = token_sets(batch.column(0).slice(start, STEP_ROWS), k)
                ids = set_ids(flat, at)
                rows = np.flatnonzero(_in_filter(bits, ids))
                rows = rows[np.unique(ids[rows], return_index=True)[1]]
                rows = rows[[x not in sent for x in ids[rows].tolist()]]
                sent.update(ids[rows].tolist())
                blobs = [flat[at[r] : at[r + 1]].tobytes() for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(blobs, pa.binary())], ["set", "tokens"])

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * common >= percent * (len(x) + len(y) - common)
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def _verified(pairs: DataFrame, rows: DataFrame, k: int, percent: int, storage: Storage, name: str) -> DataFrame:
    """The pairs ``(a, b)`` of sets that link."""
    spark = pairs.sparkSession
    asked = pairs.select(F.explode(F.array("a", "b")).alias("hash")).distinct()
    wanted = spark.sparkContext.broadcast(filter_of(asked))
    held = rows.select("text").mapInArrow(_tokens_of(wanted, k), "set long, tokens binary")
    held = held.join(asked, F.col("set") == F.col("hash"), "left_semi")
    held = storage.table(held.groupBy("set").agg(F.first("tokens").alias("tokens")), f"{name}-tokens")
    wanted.unpersist()
    # Sorted and merged: a few bytes of a pair's file are many in memory, so that sizes of files mislead Spark to broadcast.
    full = pairs.join(held.select(F.col("set").alias("a"), F.col("tokens").alias("x")).hint("merge"), "a")
    full = full.join(held.select(F.col("set").alias("b"), F.col("tokens").alias("y")).hint("merge"), "b")
    links = storage.table(full.select("a", "b", "x", "y").mapInArrow(_linked(percent), "a long, b long"), f"{name}-links")
    storage.drop(f"{name}-tokens")
    return links


# --- the join -------------------------------------------------------------------------------------


def near_groups(
    docs: DataFrame, *, k: int = 3, percent: int = 90, frequent: int = FREQUENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, group, *ROW)`` for every row of ``docs``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. ``component_id`` is the
    smallest key that links reach, the row's own included; ``group`` is a number of the component,
    NULL for rows without words. Rows of equal sets are linked. ``ROW`` are hashes of key and text. A NULL
    or empty text, or one without words, has no shingles and links with nothing. A NULL key is never
    the smallest; a component of NULL keys has a NULL id. Rows with equal key and different text are
    separate. Sets are told apart by 64-bit digests, tokens by 64-bit hashes. An empty table gives no
    rows; other columns are ignored. Keys must be of a type that ``min`` orders.
    """
    spark = docs.sparkSession
    storage = Storage(spark, "near-join")
    rows = docs.select(column(docs, key).alias("doc_id"), column(docs, text).alias("text"), *row_hashes(docs, key, text))
    kind = docs.schema[key].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    often = spark.sparkContext.broadcast(frequent_filter(rows, k, frequent, size))
    fields = f"doc_id {kind}, set long, n long, rare long, singles array<long>, pairs array<long>, {ROW[0]} long, {ROW[1]} long"
    prefixes = storage.table(rows.mapInArrow(_prefixes(often, k, percent), fields), "prefixes")
    often.unpersist()
    sets = storage.table(
        prefixes.filter("n > 0").groupBy("set", "n").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"].alias("doc_id")), "sets"
    )

    # One row of each set goes on: its entries are the same on every row.
    one = prefixes.join(sets.select(F.col("set").alias("s"), F.col("doc_id").alias("d")), (F.col("set") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")), "left_semi")
    kinds = [F.struct(F.col(x).alias("entries"), F.lit(x == "pairs").alias("two")) for x in ("singles", "pairs")]
    spots = one.select("set", "n", "rare", F.explode(F.array(*kinds)).alias("e"))
    spots = spots.select(F.explode("e.entries").alias("entry"), F.col("e.two").alias("two"), "set", "n", "rare")
    spots = spots.repartition("entry").sortWithinPartitions("entry", "two", "rare", "set")
    found = storage.table(spots.mapInArrow(_entry_pairs(percent, max(SMALL, frequent)), ", ".join(f"{x} long" for x in _FOUND)), "candidates")

    same = F.sum("single").alias("c")
    pairs = found.filter("a <> b").groupBy("a", "b", "n", "r", "m", "s").agg(same).filter(_enough_shared(percent))
    pairs = storage.table(pairs.select("a", "b"), "pairs")
    links = _verified(pairs, rows, k, percent, storage, "first")
    groups = components(links, storage, "first-stars")
    large = found.filter("a = b").select(F.col("single").alias("entry")).distinct()
    if not large.isEmpty():
        rest = _across(one, storage.table(large, "large"), groups, pairs, percent, storage)
        rest = storage.table(rest, "rest")
        if not rest.isEmpty():
            groups = with_more_links(groups, _verified(rest, rows, k, percent, storage, "rest"), storage, "rest-stars")

    # The smallest key of each component, and back to the rows.
    member = sets.join(groups, sets["set"] == groups["node"], "left").select("set", "doc_id", F.coalesce("component", "set").alias("component"))
    least = member.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = member.join(least, "component").select(F.col("set").alias("s"), "component_id", F.col("component").alias("group"))
    out = prefixes.select("doc_id", "set", "n", *ROW).join(ids, (F.col("set") == F.col("s")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "group", *ROW)


def _across(one: DataFrame, large: DataFrame, groups: DataFrame, done: DataFrame, percent: int, storage: Storage) -> DataFrame:
    """Pairs of sets of different components that share a large entry and may link.

    After the first round most sets of such an entry are one component and no longer pair. Two sets that
    share many entries pair in the least of them alone.
    """
    of = one.select("set", "n", "rare", F.explode("pairs").alias("entry")).join(groups, F.col("set") == F.col("node"), "left")
    spots = of.select("entry", "set", "n", "rare", F.coalesce("component", "set").alias("component"))
    mixed = spots.groupBy("entry").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    mixed = mixed.join(large, "entry", "left_semi").select("entry")
    spots = storage.table(spots.join(mixed, "entry", "left_semi"), "mixed")
    # A set's own entries: as many as its prefix has combinations.
    held = spots.groupBy("set").agg(F.collect_set("entry").alias("held"))
    # Merged, not broadcast, as in ``_verified``: the rows of an entry take next to nothing in the file.
    spots = spots.join(held.hint("merge"), "set")
    x, y = spots.alias("x"), spots.hint("merge").alias("y")
    n, r, m, s = (F.col(c) for c in ("x.n", "x.rare", "y.n", "y.rare"))
    most = F.least(n - r, m - s)
    union = F.greatest(n + m - most, n + s, m + r)
    may = (F.col("x.component") != F.col("y.component")) & (F.col("x.set") < F.col("y.set"))
    may &= (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (100 * most >= percent * union)
    may &= F.array_min(F.array_intersect("x.held", "y.held")) == F.col("x.entry")
    pairs = x.join(y, (F.col("x.entry") == F.col("y.entry")) & may).select(F.col("x.set").alias("a"), F.col("y.set").alias("b")).distinct()
    return pairs.join(done.hint("merge"), ["a", "b"], "left_anti")


def deduplicated(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest key.

    Of several rows with that key the one of the smallest hash stays, once; columns may have any names. Rows without words link
    with nothing and all stay.
    """
    groups = near_groups(docs, key=key, text=text, **options)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *ROW)).alias("first")
    kept = groups.filter("group is not null").groupBy("group").agg(first).select(*[f"first.{x}" for x in ROW])
    words = F.coalesce(column(docs, text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # Of rows with this key and text the one whose other columns have the least hash.
    others = [column(docs, c).alias(c) for c in docs.columns if c not in (key, text)]
    tie = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("long")
    rows = docs.select(as_struct(docs, "doc"), words.alias("words"), tie.alias("tie"), *row_hashes(docs, key, text))
    some = rows.filter("words").join(kept, list(ROW), "left_semi").groupBy(*ROW).agg(F.min_by("doc", "tie").alias("doc"))
    return some.select("doc.*").unionByName(rows.filter(~F.col("words")).select("doc.*"))
