"""The registered queries of the numbered operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat, decontaminate, divergence, mixing, near_vectors, pseudo_likelihood, quality, quality_rules, sharding, shingle_join, substring_dedup,
    token_counts, vector_codes,
)
from ledgerloom.llm.common import cut, n_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op5_sharding")
def op5(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard_by_bytes(docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


OP10_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed as (
  select *, row_number() over w as pos,
    coalesce(lag(role) over w <> role, true) as first,
    coalesce(lead(role) over w <> role, true) as last
  from rows window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(regexp_replace(text, '<(\\*)(/?s>|\|)', '<\\\1\2', 'g'))
      + case when first then 4 + length(replace(replace(replace(role, '\', '\b'), '|', '\p'), '<', '\l')) else 3 end
      + case when last then 4 else 0 end)::bigint as formatted_chars
from placed group by conv_id
"""


@query("op10_chat_formatting", OP10_SQL)
def op10(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    # the two planted rows hang on the table's type, not on its content
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), said.alias("text"),
    )
    made = chat.format_chats(turns.unionByName(planted))
    read = made.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.read_learnt(F.col("formatted"), F.col("loss_spans")), "").alias("learnt"),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op3_token_counts")
def op3(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op9_mixing")
def op9(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    sized = cut(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "source", "text").alias("key")))
    return mixing.mix_sources(sized).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op7_quality_classifier")
def op7(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.select("doc_id", "held_out", "score", "predicted")


OP6_SQL = """
with recursive usable as (
  select vec_id, label, [x::double for x in embedding] as e from embeddings
  where label is not null and vec_id is not null and embedding is not null and len(embedding) > 0
    and list_bool_and([x is not null and isfinite(x) for x in embedding])
    and list_bool_or([x <> 0 for x in embedding])
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on r.b = l.a),
low as (select a, min(b) as component_id from reach group by a),
n as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n.n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join low on low.a = vec_id left join n on n.a = vec_id
"""


@query("op6_near_vectors", OP6_SQL)
def op6(spark, sf_dir):
    return near_vectors.link_near_vectors(_table(spark, sf_dir, "embeddings"))


OP1_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents
), s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]) end as s from w
), n as (select doc_id, len(s)::bigint as n from s),
u as (select doc_id, unnest(s) as g from s),
many as (select g from u group by g having count(*) > 1),
k as (select doc_id, g from u semi join many using (g)),
common_grams as (select a.doc_id as a, b.doc_id as b, count(*) as o from k a join k b on a.g = b.g and a.doc_id <> b.doc_id group by all),
links as (
  select a, b from common_grams join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 85 * (x.n + y.n - o)
), reach(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reach r join links l on r.b = l.a)
select a as doc_id, n as n_shingles, min(b) as component_id from reach join n on n.doc_id = a group by a, n
"""


@query("op1_jaccard_join", OP1_SQL)
def op1(spark, sf_dir):
    return shingle_join.jaccard_join(_table(spark, sf_dir, "documents"), k=4, percent=85)


OP2_SQL = """
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
), starts as (
  select doc_id, unnest(range(1, len(w) - 18)) as s from w where len(w) >= 20
), windows as (
  select doc_id, s, array_to_string(w[s:s + 19], ' ') as t from starts join w using (doc_id)
), seen as (
  select doc_id, s from windows qualify row_number() over (partition by t order by doc_id, s) > 1
), gone as (
  select distinct doc_id, s + k as i from seen, range(0, 20) r(k)
), places as (
  select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from w
), kept as (
  select doc_id, string_agg(word, ' ' order by i) as t, count(*) as n from places anti join gone using (doc_id, i) group by doc_id
)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (doc_id)
"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark, sf_dir):
    kept = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op4_decontamination")
def op4(spark, sf_dir):
    """One row per run of matching windows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.match_benchmark(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


@query("op8_pseudo_likelihood")
def op8(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudo_likelihood.score_pseudo_likelihood(docs).select("doc_id", "n_words", "score", "mean_score")


OP11_SQL = r"""
with d as (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
t as (
  select doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
), keep as (select lang, term from t group by all having count(distinct doc) >= 30),
c as (select lang, source, term, count(*)::hugeint as n from t semi join keep using (lang, term) group by all),
g as (select distinct lang, source from d),
kept_of as (select lang, count(*)::hugeint as v from keep group by lang),
sizes as (
  select g.lang, g.source, coalesce(any_value(k.v), 0) as v, coalesce(sum(c.n), 0)::hugeint + 5 * coalesce(any_value(k.v), 0) as total
  from g left join kept_of k on k.lang = g.lang left join c on c.lang = g.lang and c.source = g.source group by g.lang, g.source
), p as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // s.total as p
  from sizes s join keep k on k.lang = s.lang left join c on c.lang = s.lang and c.source = s.source and c.term = k.term
), lang_n as (select lang, term, sum(n)::hugeint as n from c group by all),
lang_total as (select lang, sum(n)::hugeint + 5 * count(*) as total from lang_n group by lang),
q as (select lang, term, 1 + (1000000000::hugeint * (n + 5)) // total as q from lang_n join lang_total using (lang)),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum(abs(x.p - y.p)), 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join p x on x.lang = a.lang and x.source = a.source
  left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
), terms as (select lang, source, term as item, p - q as value from p join q using (lang, term) where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all
  select * from (select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) as rank from terms) where rank <= 50
)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark, sf_dir):
    return divergence.audit_sources(_table(spark, sf_dir, "documents").select("lang", "source", "text"))


def _op12_assigned(books: str) -> str:
    """Each part with the nearest entry of these codebooks."""
    far = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(part, c)])"
    return f"(select n, p, any_value(part) as part, min({far} * 64 + j) // 64 as d, min({far} * 64 + j) % 64 as j from parts join {books} using (p) group by n, p)"


def _op12_moved(assigned: str, books: str) -> str:
    """Codebooks whose used entries are the floor of the mean of their parts."""
    means = f"""(select p, j, list(m order by k) as c from (
      select p, j, k, (sum(part[k]) - ((sum(part[k]) % count(*)) + count(*)) % count(*)) // count(*) as m
      from {assigned} join (select unnest(range(1, 1 + (select max(len(part)) from parts))) as k) on true group by p, j, k) group by p, j)"""
    return f"(select p, j, coalesce(m.c, b.c) as c from {books} b left join {means} m using (p, j))"


OP12_SQL = f"""
with v as materialized (
  select row_number() over (order by vec_id) as n, vec_id, label, [floor(256 * x::double)::bigint for x in embedding] as e from embeddings
  where embedding is not null and list_bool_and([x is not null and isfinite(x) for x in embedding])
), parts as materialized (
  select n, p, e[p * len(e) // 16 + 1:(p + 1) * len(e) // 16] as part from v, (select unnest(range(16)) as p)
), b0 as materialized (select p, n - 1 as j, part as c from parts where n <= 64),
a0 as materialized (select * from {_op12_assigned("b0")}),
b1 as materialized (select * from {_op12_moved("a0", "b0")}),
a1 as materialized (select * from {_op12_assigned("b1")}),
b2 as materialized (select * from {_op12_moved("a1", "b1")}),
a2 as materialized (select * from {_op12_assigned("b2")}),
coded as (select n, string_agg(format('{{:02x}}', j::bigint), '' order by p) as code, sum(d)::bigint as error from a2 group by n),
sha as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, j)) as codebooks_sha256 from b2)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from v join coded using (n), sha
"""


@query("op12_vector_codes", OP12_SQL)
def op12(spark, sf_dir):
    return vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings")).drop("label")


OP13_SQL = r"""
with d as (select row_number() over () as n, doc_id, lang, source, coalesce(text, '') as text from documents),
w as (select n, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from d),
lines as (
  select n, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines
  from (select n, unnest(string_split(text, chr(10))) as l from d) where regexp_matches(l, '[^\x20\x09-\x0D]') group by n
), windows as (
  select n, s, array_to_string(w[s:s + 4], ' ') as t from (select n, w, unnest(range(1, len(w) - 3)) as s from w where len(w) >= 5)
), twice as (select n, s from windows qualify count(*) over (partition by n, t) > 1),
repeats as (select n, count(distinct s + k) as n_repeat_words from twice, range(0, 5) r(k) group by n),
c as (
  select doc_id, lang, source, len(w)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines
  from d join w using (n) left join lines using (n) left join repeats using (n)
), b as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    [1000 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(n_words, 1),
     1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)] as rates from c
), v as (
  select lang, source, rule, rate - rate % (1::bigint << greatest(length(bin(rate)) - 7, 0)) as bucket
  from (select lang, source, unnest(range(1, 5)) as rule, unnest(rates) as rate from b where not base_failed)
), levels as (
  select 's' as level, lang, source, rule, bucket from v union all select 'l', lang, null, rule, bucket from v union all select 'a', null, null, rule, bucket from v
), sketches as (select level, lang, source, rule, bucket, count(*) as n from levels group by all),
seen as (
  select *, sum(n) over (partition by level, lang, source, rule order by bucket) as below, sum(n) over (partition by level, lang, source, rule) as size from sketches
), q as (
  select level, lang, source, rule, any_value(size) as size, min(bucket) filter (4 * below >= size) as low, min(bucket) filter (4 * below >= 3 * size) as high
  from seen group by all
), used as (
  select s.lang, s.source, s.rule,
    case when s.size >= 100 then s.low when l.size >= 100 then l.low else a.low end as low,
    case when s.size >= 100 then s.high when l.size >= 100 then l.high else a.high end as high
  from q s join q l on s.level = 's' and l.level = 'l' and l.lang is not distinct from s.lang and l.rule = s.rule
  join q a on a.level = 'a' and a.rule = s.rule
), far as (select *, 6 * greatest(high - low, [100, 50, 75, 30][rule]) as far from used),
limits as (select lang, source, list(low - far order by rule) as low, list(high + far order by rule) as high from far group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and rates[1] between low[1] and high[1] and rates[2] <= high[2] and rates[3] <= high[3] and rates[4] <= high[4] as kept
from b left join limits on b.lang is not distinct from limits.lang and b.source is not distinct from limits.source
"""


@query("op13_quality_rules", OP13_SQL)
def op13(spark, sf_dir):
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents")).drop("failed_rules")
