"""One query per operator, with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelog.llm import chat_format, class_lm, decontaminate, fuzzy_lines, licenses, mil_quality, mixing, near_join, packing, phrases, target_ratio, token_files, vector_codes
from tablelog.llm.storage import Storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = r"""
with sized as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '')) as spread,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents),
placed as (
  select *, coalesce(sum(size) over (partition by source order by spread, doc_id, size
    rows between unbounded preceding and 1 preceding), 0)::bigint as p from sized),
ranked as (
  select source, sum(size)::bigint as source_size, sum(size)::bigint * 2 as lim,
    [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint]::double as w,
    row_number() over (order by source nulls last) as sid
  from sized group by source),
cut as (
  select *, sum(source_size) over ()::double * 1.5 as budget,
    sum(source_size) over ()::double * 1.5 - coalesce(sum(lim) over o, 0) as remains,
    sum(w) over () - coalesce(sum(w) over o, 0) as rest
  from ranked window o as (order by lim / w, sid rows between unbounded preceding and 1 preceding)),
goal as (
  select *, case when remains * w > lim * rest then lim::double
    else (budget - coalesce(sum(case when remains * w > lim * rest then lim end) over (), 0)) * w
      / sum(case when not remains * w > lim * rest then w end) over () end as target
  from cut),
want as (select *, floor(target + 0.5)::bigint as words from goal)
select doc_id, size, source_size, target,
  (case when source_size = 0 then 0 else (words // source_size) * size
    + greatest(0, least(p + size, words % source_size) - p) end)::bigint as taken
from placed join want on placed.source is not distinct from want.source
"""


@_query(OP1_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a mix of 150 % of their words, sources weighing 5, 2, 1 in turn."""
    taken = mixing.mix_sources(_table(spark, sf_dir, "documents")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer of that name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_digests(docs: DataFrame) -> DataFrame:
    """``docs`` written as token files, and what the files hold of every document."""
    files = token_files.write_token_files(docs, Storage(docs.sparkSession, "tokens").path, tokenizer=tokenizer_path())
    asked = docs.select(F.col("doc_id").alias("key")).distinct()
    return token_files.read_documents(files, asked).withColumnRenamed("key", "doc_id")


@_query()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in binary shards, read back by key."""
    return token_digests(_table(spark, sf_dir, "documents"))


OP5_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents),
i as (
  select item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
sized as (select *, least(10, len(w)) as n from i where len(w) > 0),
starts as (select item_id, n, w, unnest(range(1, len(w) - n + 2)) as p from sized),
windows as (select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as g from starts),
lengths as (select distinct n from sized),
grams as (select r, n, p, array_to_string(w[p:p + n - 1], ' ') as g
  from (select r, n, w, unnest(range(1, len(w) - n + 2)) as p from d, lengths where len(w) >= n)),
found as (select r, n, p, item_id from grams join windows using (n, g)),
hit as (select r, count(distinct k) as n_hit from (select r, unnest(range(p, p + n)) as k from found) group by r),
named as (select r, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct r, item_id from found) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join named using (r)
"""


@_query(OP5_SQL)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document also stands in the benchmark."""
    spans = decontaminate.benchmark_spans(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["to"] - x["from"])
    return spans.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
with recursive d as (
  select doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as w
  from documents),
grams as (
  select distinct doc_id, g from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g from d)),
n as (select doc_id, count(*) as n from grams group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from grams a join grams b using (g)
  where a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
edges as (select a, b from links union all select b, a from links),
reach(doc_id, id) as (
  select doc_id, doc_id from d union select e.b, r.id from reach r join edges e on e.a = r.doc_id)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.id as component_id
from d left join n using (doc_id) join (select doc_id, min(id) as id from reach group by doc_id) r using (doc_id)
"""


@_query(OP7_SQL)
def op7_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingles agree to 90 %."""
    groups = near_join.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


@_query()
def op10_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from labels of four fifths of the keys."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mil_quality.learn(docs, _table(spark, sf_dir, "labels"))
    scored = mil_quality.score(docs, model)
    predicted = (F.col("score") >= 0.3).cast("int")
    return scored.select("doc_id", mil_quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


@_query()
def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under unigrams and a class-based bigram model."""
    return class_lm.class_perplexity(_table(spark, sf_dir, "documents"))


@_query()
def op6_target_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and likelihood ratio of every document; documents labelled good are trusted."""
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1")
    return target_ratio.quality_verdicts(_table(spark, sf_dir, "documents"), trusted)


OP9_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
g as (
  select conv_id, count(*) as n,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as loss,
    sum(length(role) + 1 + length(text) + 23)::bigint as plain,
    sum(len(regexp_extract_all(text, '<\\*\|')))::bigint as escapes,
    bool_or(regexp_matches(text, '<\|(im_start|im_end|nl)\|>|<\\+\|')) as conflict
  from c group by conv_id)
select conv_id, n as n_turns, sha256(turns) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256,
  plain + case when conflict then escapes else 0 end as formatted_chars
from g
"""


@_query(OP9_SQL)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as training text, read back; one more has the marks in its texts."""
    held = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], held.schema)
    out = chat_format.format_conversations(held.unionByName(extra))
    turns = F.transform(chat_format.parsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    unmasked = chat_format.loss_text(F.col("formatted"), F.col("loss"))
    return out.withColumns({"turns": turns, "unmasked": unmasked}).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("unmasked").cast("long").alias("loss_chars"),
        F.sha2("unmasked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@_query()
def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and how many of them stay when near copies go."""
    kept = fuzzy_lines.kept_lines(_table(spark, sf_dir, "documents"))
    places = F.array_join(F.transform("kept", lambda x: x.cast("string")), ",")
    return kept.select("doc_id", "n_lines", F.size("kept").cast("long").alias("n_kept"), F.sha2(places, 256).alias("kept_sha256"))


@_query()
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document states."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("licenses", ",").alias("licenses"))


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
total as (select lang, sum(len(w))::hugeint as n from w group by lang),
starts as (select lang, w, k, unnest(range(1, len(w) - k + 2)) as p from w, (select unnest(range(1, 6)) as k) where len(w) >= k),
grams as (
  select lang, k, phrase, count(*)::hugeint as f
  from (select lang, k, array_to_string(w[p:p + k - 1], ' ') as phrase from starts) group by lang, k, phrase having count(*) >= 100),
found as (select lang, k, phrase, f, string_split(phrase, ' ') as w from grams where k >= 2),
inner_parts as (
  select x.lang, unnest(list_transform(range(1, x.k - j + 2), lambda p: array_to_string(x.w[p:p + j - 1], ' '))) as phrase, x.f
  from found x, (select unnest(range(2, 5)) as j) where j < x.k),
longer as (select lang, phrase, max(f) as f from inner_parts group by lang, phrase),
kept as (select x.* from found x left join longer y using (lang, phrase) where y.f is null or 100 * y.f < 100 * x.f),
cuts as (select *, unnest(range(1, k)) as c from kept),
scored as (
  select x.lang, x.phrase, x.c, x.f as a, l.f as l, r.f as r, t.n, (1000 * x.f * t.n) // (l.f * r.f) as score
  from cuts x join total t on t.lang = x.lang
  join grams l on l.lang = x.lang and l.phrase = array_to_string(x.w[1:x.c], ' ')
  join grams r on r.lang = x.lang and r.phrase = array_to_string(x.w[x.c + 1:], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from best)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""


@_query(OP11_SQL)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 collocations."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def _op12_sql() -> str:
    """Four rounds of assignment and update, written out."""
    squares = "list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x)"
    sql = [
        r"""with kept as (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select r, q, v[q * len(v) // 4 + 1:(q + 1) * len(v) // 4] as x from kept, (select unnest(range(4)) as q)),
books0 as materialized (
  select p.q, s.entry, p.x from parts p join (select r, row_number() over (order by vec_id) - 1 as entry from kept) s using (r) where s.entry < 256)"""
    ]
    for turn in range(5):
        sql.append(
            f"""near{turn} as materialized (
  select r, q, entry, d from (select p.r, p.q, c.entry, {squares} as d from parts p join books{turn} c using (q))
  qualify row_number() over (partition by r, q order by d, entry) = 1)"""
        )
        if turn < 4:
            sql.append(
                f"""books{turn + 1} as materialized (
  select b.q, b.entry, coalesce(m.x, b.x) as x from books{turn} b left join (
    select q, entry, list(mean order by i) as x from (
      select n.q, n.entry, u.i, floor(sum(p.x[u.i]) / count(*)) as mean
      from near{turn} n join parts p using (r, q), (select unnest(range(1, 1 + (select max(len(x)) from parts))) as i) u group by n.q, n.entry, u.i)
    group by q, entry) m using (q, entry))"""
            )
    sql.append(
        """codes as (
  select k.vec_id, k.label, string_agg(lpad(lower(to_hex(n.entry)), 2, '0'), '' order by n.q) as code, sum(n.d)::bigint as error
  from near4 n join kept k using (r) group by k.r, k.vec_id, k.label),
flat as (select sha256(string_agg(array_to_string(list_transform(x, lambda v: v::bigint::varchar), ','), ',' order by q, entry)) as h from books4)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256 from codes, flat"""
    )
    return ",\n".join(sql[:-1]) + ",\n" + sql[-1]


@_query(_op12_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as codes of four bytes."""
    codes = vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(codes.rows)
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))


@_query()
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 tokens."""
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer=tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
