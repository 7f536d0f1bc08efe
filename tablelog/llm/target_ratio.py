"""Quality rules with a hashed n-gram likelihood ratio (operator 6).

Words and pairs of neighbouring words fall into hash buckets, about 16 to 32 n-grams of trusted
documents to each. Two multinomials over the buckets, one of documents that are trusted and one of
all documents, give each bucket the logarithm of its ratio. A document's score is the mean over its
n-grams, so length does not matter, and a fixed threshold decides that allows for chance. Before that, plain rules reject
texts of few words or of much repetition.

Only DataFrame functions run here. Ratios are whole millionths and their sums are exact, so the same
rows always give the same verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelog.llm.storage import ROW, Storage, as_struct, column, row_hashes

SYMBOL = r"[#*$%&|<>]"

#: Buckets at least and at most, as powers of two; the table of ratios goes to all tasks.
BITS = (10, 18)
#: Trusted n-grams of a bucket, at least where the limits allow it.
FILL = 16
#: Trusted documents that are learned from, at most: those of the smallest hashes of keys.
SAMPLE = 20_000
#: Least mean of log ratios of a document that is kept: LEAST for a long one, and less by NOISE over
#: the square root of its n-grams, which is how far the mean of a short one strays by chance.
LEAST, NOISE = -0.06, 0.5
#: Words of a repeated window, least words of a text, and percent of its words that may repeat.
WINDOW, LEAST_WORDS, REPEATED = 5, 10, 20

_MICRO = 1_000_000


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


_SPACE = " \t\n\x0b\x0c\r"


#: What the plain rules count and say.
RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _words(text: Column) -> Column:
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+", -1))


def text_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with what the plain rules count: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed. Columns of these names are replaced.

    ``n_repeat_words`` counts words inside windows of ``WINDOW`` words that stand twice or more in
    the text. Windows are sorted by hash, which brings equal ones together; a text without equal
    hashes needs no more. Places of repeated windows in order cover ``min(WINDOW, distance to the
    next)`` words each, so that overlaps count once.
    """
    whole = F.coalesce(column(docs, text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(as_struct(docs, "doc"), _words(whole).alias("__words"), lines.alias("__lines"), F.regexp_count(whole, F.lit(SYMBOL)).cast("long").alias("n_symbols"))
    words = F.col("__words")
    out = out.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__hashes": F.transform(words, lambda x: F.xxhash64(x)),
        }
    ).drop("__words", "__lines")
    # Hashes of two, four and five words in a row, each from those before; a NULL marks the end.
    two = F.zip_with("__hashes", F.slice("__hashes", 2, 1 << 30), lambda x, y: F.xxhash64(x, y))
    out = out.withColumn("__two", two)
    four = F.zip_with("__two", F.slice("__two", 3, 1 << 30), lambda x, y: F.xxhash64(x, y))
    five = F.zip_with(four, F.slice("__hashes", WINDOW, 1 << 30), lambda x, y: F.xxhash64(x, y))
    whole = F.slice(five, 1, F.greatest(F.col("n_words") - (WINDOW - 1), _long(0)).cast("int"))
    out = out.withColumn("__windows", whole).drop("__hashes", "__two")
    out = out.withColumn("__again", F.size(F.array_distinct("__windows")) < F.size("__windows"))
    spots = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__spots", F.when(F.col("__again"), spots)).drop("__windows")
    like = lambda x, i: F.coalesce(F.get("__spots", i)["h"] == x["h"], F.lit(False))
    twice = F.filter("__spots", lambda x, i: like(x, i - 1) | like(x, i + 1))
    out = out.withColumn("__twice", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("__spots", "__again")
    covered = F.transform("__twice", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__twice", i + 1), p + WINDOW) - p))
    total = F.aggregate(covered, _long(0), lambda a, x: a + x)
    out = out.withColumn("n_repeat_words", F.coalesce(total, _long(0))).drop("__twice")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in RULES], *RULES)


def _grams(docs: DataFrame, text: str, buckets: int, *keep: Column) -> DataFrame:
    """One row per n-gram: its bucket, and the columns ``keep``.

    Each word comes with the next one, NULL after the last, and is hashed in generated code.
    """
    names = [c for c in docs.select(*keep).columns]
    split = docs.select(*keep, _words(column(docs, text)).alias("__w"))
    pairs = F.arrays_zip(F.col("__w").alias("x"), F.slice("__w", 2, 1 << 30).alias("y"))
    words = split.select(*names, F.explode(pairs).alias("__p")).select(*names, F.col("__p.x").alias("__x"), F.col("__p.y").alias("__y"))
    bucket = lambda h: F.pmod(h, _long(buckets)).cast("int")
    two = F.when(F.col("__y").isNotNull(), bucket(F.xxhash64("__x", "__y")))
    both = words.select(*names, F.explode(F.array(bucket(F.xxhash64("__x")), two)).alias("bucket"))
    return both.filter("bucket is not null")


def likelihood_ratios(
    docs: DataFrame, trusted: DataFrame, storage: Storage, *, key: str = "doc_id", text: str = "text", trusted_key: str = "doc_id", sample: int = SAMPLE
) -> tuple[DataFrame, int]:
    """``(bucket, ratio)`` in millionths, and the number of buckets.

    The ratio is the log of a bucket's share among trusted n-grams over that among all. All documents
    count; of the ``trusted`` keys those of the ``sample`` smallest hashes. Half a count is added
    everywhere. Without trusted documents all ratios are 0.
    """
    chosen = trusted.select(column(trusted, trusted_key).alias("__key")).filter("__key is not null").distinct()
    chosen = chosen.orderBy(F.xxhash64("__key"), "__key").limit(sample).withColumn("__trusted", F.lit(1))
    rows = docs.select(column(docs, key).alias("__id"), column(docs, text).alias("__text"))
    some = rows.join(F.broadcast(chosen), F.col("__id") == F.col("__key"))  # ``sample`` rows at most
    n_grams = some.agg(F.sum(F.greatest(2 * F.size(_words(F.col("__text"))) - 1, F.lit(0)))).first()[0] or 0
    buckets = 1 << min(max((n_grams // FILL).bit_length() - 1, BITS[0]), BITS[1])
    marked = rows.join(F.broadcast(chosen), F.col("__id") == F.col("__key"), "left")
    counts = _grams(marked, "__text", buckets, F.col("__trusted")).groupBy("bucket").agg(F.count("*").alias("n"), F.count("__trusted").alias("m"))
    counts = storage.table(counts, "counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("m").alias("m")).first()
    share = lambda x: (F.col(x) + 0.5) / F.lit(total[x] + 0.5 * buckets)
    ratio = F.log(share("m")) - F.log(share("n")) if total["m"] else F.lit(0.0)
    return counts.select("bucket", F.round(ratio * _MICRO).cast("long").alias("ratio")), buckets


def quality_verdicts(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    trusted_key: str = "doc_id",
    sample: int = SAMPLE,
    least: float = LEAST,
    noise: float = NOISE,
) -> DataFrame:
    """The rules' counts and the verdict for every row of ``docs``.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    ratio (mean log ratio of the n-grams), kept. A NULL or empty text has no words, ratio 0, and
    fails. Equal rows have equal verdicts. An empty table gives no rows; other columns are ignored.
    The table of ratios has a row per bucket and goes to all tasks.
    """
    storage = Storage(docs.sparkSession, "target-ratio")
    rows = docs.select(column(docs, key).alias("doc_id"), column(docs, text).alias("text"))
    ratios, buckets = likelihood_ratios(docs, trusted, storage, key=key, text=text, trusted_key=trusted_key, sample=sample)
    ratios = storage.table(ratios, "ratios")
    hashed = rows.select("text", *row_hashes(rows, "doc_id", "text"))
    grams = _grams(hashed, "text", buckets, *[F.col(x) for x in ROW])
    scores = grams.join(F.broadcast(ratios), "bucket").groupBy(*ROW).agg(F.sum("ratio").alias("sum"), F.count("*").alias("n"))
    scores = scores.select(*ROW, F.round(F.col("sum") / F.col("n")).cast("long").alias("micro"))
    grams_of = F.greatest(2 * F.col("n_words") - 1, _long(1))
    bound = F.round((least - noise / F.sqrt(grams_of)) * _MICRO).cast("long")
    counts = text_rules(rows.withColumns(dict(zip(ROW, row_hashes(rows, "doc_id", "text"))))).drop("text")
    out = counts.join(scores, list(ROW), "left").withColumn("micro", F.coalesce("micro", _long(0)))
    kept = ~F.col("base_failed") & (F.col("micro") >= bound)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (F.col("micro") / _MICRO).alias("ratio"), kept.alias("kept")
    )
