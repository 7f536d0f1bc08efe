"""Mixing sources to target weights by a low-discrepancy schedule (operator 1).

The words of each source, its documents in a shuffled order, form one stream that is cut into
blocks of equal size. The schedule has as many slots as all sources need together. Van der Corput
points 0, 1/2, 1/4, 3/4, ... are mapped through the sources' cumulative shares, so that every
stretch of the schedule holds each source in its share; the r-th slot of a source takes its r-th
block, beginning again at the first one when all are used. Slots are ranked by arithmetic, streams
are laid out by running sums of two levels, and slots meet blocks by (source, block): no step holds
the rows of a source together, however large it is.

Only DataFrame functions run here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelog.llm.storage import Storage, as_struct, column

WORD = r"[^\x20\x09-\x0D]+"

#: Slots that one row of the schedule's plan unfolds to at a time.
CHUNK = 1 << 13


@dataclass(frozen=True)
class Mixture:
    """sources: one row per source (sid, source, source_size, weight, target, words to take, slots).
    slots: the schedule (slot, sid, rank, turn, block, quota).
    positions: every document with its place in its source's stream.
    pieces: per document and block, the words of it that a slot takes (slot NULL: none)."""

    sources: DataFrame
    slots: DataFrame
    positions: DataFrame
    pieces: DataFrame

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken, source, stream_start: one row per document."""
        keys = ["doc_id", "size", "source_size", "target", "source", "stream_start"]
        some = self.pieces.groupBy(*keys).agg(F.sum("words").alias("taken"))
        none = self.positions.filter("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
        return some.unionByName(none).select(*keys[:4], "taken", *keys[4:])


def mix_sources(
    docs: DataFrame,
    *,
    share: float = 1.5,
    weights: Sequence[float] = (5, 2, 1),
    repeats: int = 2,
    block_words: int = 1024,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> Mixture:
    """A mixture of ``share`` times all words, in which sources weigh ``weights`` in turn.

    Sources are ordered by code point, NULL last. No source gives more than ``repeats`` times its
    words; what that cuts off is shared among the others by weight. A source's slots take exactly
    its target, rounded to a word, so no document is taken more than ``repeats`` times.

    A NULL or empty text has size 0 and is never taken. A source without words has target 0. Equal
    rows stay apart and follow each other in the stream. An empty table gives empty results. Other
    columns are ignored. One row per source, the sources' plan, passes through one task.
    """
    storage = Storage(docs.sparkSession, "mixing")
    spread = F.md5(F.coalesce(column(docs, key).cast("string"), F.lit("")))
    sized = storage.table(
        docs.select(
            column(docs, key).alias("doc_id"),
            column(docs, source).alias("source"),
            F.coalesce(F.regexp_count(column(docs, text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            spread.alias("spread"),
        ),
        "sizes",
    )
    # About as many buckets for a source as documents in a bucket: either level stays small.
    bands = max(1, math.isqrt(sized.count()))
    head = F.conv(F.substring("spread", 1, 8), 16, 10).cast("long")
    sized = sized.withColumn("band", F.shiftright(head * bands, 32))

    per_band = sized.groupBy("source", "band").agg(F.sum("size").alias("band_size"))
    sources = storage.table(
        _plan(per_band.groupBy("source").agg(F.sum("band_size").alias("source_size")), share, weights, repeats, block_words),
        "sources",
    )
    earlier = Window.partitionBy("source").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    per_band = per_band.withColumn("before", F.coalesce(F.sum("band_size").over(earlier), F.lit(0))).alias("b")
    plan = sources.alias("s")
    per_band = per_band.join(plan, F.col("b.source").eqNullSafe(F.col("s.source"))).select(
        F.col("b.source").alias("of"), F.col("b.band").alias("in"), "before", "sid", "source_size", "target"
    )
    inside = Window.partitionBy("source", "band").orderBy("spread", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    positions = (
        sized.withColumn("offset", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(per_band, F.col("source").eqNullSafe(F.col("of")) & (F.col("band") == F.col("in")))
        .select("doc_id", "source", "sid", "size", "source_size", "target", (F.col("before") + F.col("offset")).alias("stream_start"))
    )
    positions = storage.table(positions, "positions")
    storage.drop("sizes")

    # Written, so that their true size is known, and met by sorting: they are as many as the blocks.
    slots = storage.table(_schedule(sources, block_words), "slots").hint("merge")
    end = F.col("stream_start") + F.col("size")
    block = F.lit(block_words).cast("long")
    pieces = positions.filter("size > 0").withColumn("block", F.explode(F.sequence(_div("stream_start", block), _div(end - 1, block))))
    start = F.greatest("stream_start", F.col("block") * block)
    pieces = (
        pieces.withColumn("from", start - F.col("stream_start"))
        .withColumn("to", F.least(end, (F.col("block") + 1) * block) - F.col("stream_start"))
        .alias("p")
        .join(slots.alias("t"), (F.col("p.sid") == F.col("t.sid")) & (F.col("p.block") == F.col("t.block")), "left")
    )
    limit = F.col("p.block") * block + F.coalesce("quota", F.lit(0)) - F.col("stream_start")
    pieces = pieces.select(
        "doc_id", "source", "p.sid", "size", "source_size", "target", "stream_start", "p.block", "slot", "turn", "from",
        F.greatest(F.lit(0).cast("long"), F.least("to", limit) - F.col("from")).alias("words"),
    )
    return Mixture(sources, slots, positions, pieces)


def _div(a: Column | str, b: Column) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    return ((a - a % b) / b).cast("long")


def _plan(sizes: DataFrame, share: float, weights: Sequence[float], repeats: int, block_words: int) -> DataFrame:
    """Weights, targets and slots of the sources.

    By rising ``limit / weight`` the limited sources come first: a source is limited if what the
    earlier ones leave, shared by weight among it and the later ones, exceeds its limit.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    out = sizes.withColumn("sid", (F.row_number().over(order) - 1).cast("long")).withColumn("weight", turn)
    out = out.withColumn("limit", F.col("source_size") * repeats)
    everything = Window.partitionBy()
    poorest = Window.orderBy(F.col("limit") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    out = out.withColumn("budget", budget).withColumn("left", F.col("budget") - F.coalesce(F.sum("limit").over(poorest), F.lit(0)))
    out = out.withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(poorest), F.lit(0.0)))
    out = out.withColumn("limited", F.col("left") * F.col("weight") > F.col("limit") * F.col("rest"))
    spent = F.coalesce(F.sum(F.when(F.col("limited"), F.col("limit"))).over(everything), F.lit(0))
    free = F.sum(F.when(~F.col("limited"), F.col("weight"))).over(everything)
    target = F.when(F.col("limited"), F.col("limit").cast("double")).otherwise((F.col("budget") - spent) * F.col("weight") / free)
    out = out.withColumn("target", target).withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    block = F.lit(block_words).cast("long")
    safe = F.greatest("source_size", F.lit(1).cast("long"))
    out = out.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")).withColumn("turns", _div("words", safe))
    out = out.withColumn("tail", F.col("words") - F.col("turns") * F.col("source_size"))
    out = out.withColumn("slots", F.col("turns") * F.col("blocks") + F.ceil(F.col("tail") / block).cast("long"))
    first = F.coalesce(F.sum("slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return out.withColumn("first", first).select(
        "sid", "source", "source_size", "weight", "target", "words", "blocks", "turns", "tail", "slots", "first"
    )


def _schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """The slots of all sources with their van der Corput places, ranks and blocks."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, int(total - 1).bit_length()) if total else 1
    chunk = F.lit(CHUNK).cast("long")
    wide = sources.filter("slots > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("slots") - 1, chunk))))
    # Few rows that unfold to many: one task for a chunk or two, whatever their number.
    wide = wide.repartition(max(1, total // CHUNK), "sid", "chunk")
    last = F.least((F.col("chunk") + 1) * chunk, F.col("slots")) - 1
    wide = wide.withColumn("share", F.explode(F.sequence(F.col("first") + F.col("chunk") * chunk, F.col("first") + last)))
    place = F.conv(F.reverse(F.lpad(F.bin("share"), bits, "0")), 2, 10).cast("long")
    out = wide.withColumn("slot", place).withColumn("rank", rank_in_share("share", F.col("first"), F.col("slots"), bits))
    out = out.withColumn("turn", _div("rank", F.col("blocks"))).withColumn("block", F.col("rank") - F.col("turn") * F.col("blocks"))
    block = F.lit(block_words).cast("long")
    quota = F.when(F.col("turn") < F.col("turns"), block).otherwise(F.least(block, F.col("tail") - F.col("block") * block))
    return out.select("slot", "sid", "rank", "turn", "block", quota.alias("quota"))


def rank_in_share(share: str, first: Column, n: Column, bits: int) -> Column:
    """How many of the numbers ``first .. first + n - 1`` have a smaller bit reversal than ``share``.

    A number's reversal is smaller if, at the lowest bit where the two differ, ``share`` has the 1.
    So for each 1-bit b of ``share`` one counts the numbers with the bits of ``share`` below b and
    0 at b: a residue class modulo 2^(b+1).
    """
    value, rank = F.col(share), F.lit(0).cast("long")
    for b in range(bits):
        modulus = 1 << (b + 1)
        residue = value.bitwiseAND(F.lit((1 << b) - 1).cast("long"))
        up_to = lambda m: F.shiftright(m + F.lit(modulus - 1).cast("long") - residue, b + 1)  # noqa: E731, B023
        count = up_to(first + n) - up_to(first)
        rank = rank + F.when(value.bitwiseAND(F.lit(1 << b).cast("long")) != 0, count).otherwise(F.lit(0).cast("long"))
    return rank


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mixture takes them: each as often as it holds the document, rounded.

    A document of which less than half is taken is left out, one taken twice is there twice.
    Columns are those of ``docs``. Rows with equal key and size share what they take evenly.
    """
    names = {k: options.get(k, d) for k, d in (("key", "doc_id"), ("text", "text"))}
    taken = mix_sources(docs, **options).taken()
    copies = taken.groupBy("doc_id", "size").agg(
        F.floor(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1)) + 0.5).cast("int").alias("copies")
    )
    size = F.coalesce(F.regexp_count(column(docs, names["text"]), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(as_struct(docs, "doc"), column(docs, names["key"]).alias("id"), size.alias("words"))
    chosen = rows.join(copies, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("words") == F.col("size"))).filter("copies > 0")
    return chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
