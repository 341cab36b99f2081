"""The registered query of each operator, and its check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amihan.llm import (
    byte_bpe,
    chat,
    collocations,
    filter_audit,
    hilbert,
    lang_id,
    mixing,
    near_dedup,
    pii,
    piecewise_hash,
    suffix_dedup,
    topk_nra,
    wacz,
)
from amihan.llm.common import table, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = run
        if sql is not None:
            CHECK_SQL[key] = sql
        return run

    return register


def sha256_hex(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


OP1_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from whole q join whole c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)
)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 5
"""


@query("op1_topk_search", OP1_SQL)
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_nra.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


OP2_SQL = """
with sizes as (
  select source, sum(coalesce(length(text), 0) + 1) as size from documents group by source
), total as (select sum(size) as size, sum(pow(size, 0.5)) as weight from sizes),
rates as (
  select s.source, 1.0::double * t.size / t.weight * pow(s.size, 0.5) / s.size as rate from sizes s, total t
), plan as (
  select source, rate, greatest(1, ceil(rate / 16.0))::int as pieces from rates
), terms as (
  select source, pieces, k,
         exp(-rate / pieces) * pow(rate / pieces, k) / gamma(k + 1) as p
  from plan, (select unnest(range(81)) as k)
), cdf as (
  select source, pieces, k, sum(p) over (partition by source order by k) as c from terms
), cdfs as (select source, any_value(pieces) as pieces, list(c order by k) as c from cdf group by source),
draws as (
  select d.*, list_sum(list_transform(range(1, r.pieces + 1), lambda i: len(list_filter(r.c, lambda c:
      c < (('0x' || substr(md5('17|' || d.doc_id || '|' || i), 1, 13))::bigint + 0.5) / 4503599627370496.0))))::bigint as n_copies
  from documents d join cdfs r on d.source is not distinct from r.source
)
select doc_id, text, lang, source, n_chars, n_copies, copy_no,
       md5('17 order|' || doc_id || '|' || copy_no) as shuffle_key
from (select *, unnest(range(1, n_copies + 1)) as copy_no from draws)
"""


@query("op2_mix_sources", OP2_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weighed by the square root of their size; as much text as there is now."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op3_piecewise_hash")
def op3_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piecewise_hash.neighbour_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", sha256_hex(F.col("edited_text")).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


OP4_SQL = """
with raw as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
  select doc_id, p, md5(h[2 * p + 1:2 * p + 100]) as w
  from (select doc_id, h, unnest(range(0, len(h) // 2 - 49)) as p from raw where len(h) >= 100)
), owned as (select w, min(doc_id) as first_id from windows group by w having count(*) > 1),
marked as (select x.doc_id, x.p from windows x join owned o on x.w = o.w and o.first_id < x.doc_id),
spans as (
  select doc_id, min(p) as b, max(p) + 50 as e
  from (select *, sum(opens) over (partition by doc_id order by p) as run
        from (select *, (coalesce(p - lag(p) over (partition by doc_id order by p) > 50, true))::int as opens from marked))
  group by doc_id, run
), kept as (
  select r.doc_id, r.h, coalesce(sum(s.e - s.b), 0)::bigint as n_removed, count(s.b) as n_spans,
         list(s.b order by s.b) filter (s.b is not null) as bs, list(s.e order by s.b) filter (s.b is not null) as es
  from raw r left join spans s using (doc_id) group by r.doc_id, r.h
)
select doc_id, len(h)::bigint // 2 as n_bytes, n_removed, n_spans,
  sha256(unhex(case when bs is null then h else array_to_string(list_transform(range(0, len(bs) + 1), lambda i:
    h[2 * (case when i = 0 then 0 else es[i] end) + 1:2 * (case when i = len(bs) then len(h) // 2 else bs[i + 1] end)]), '') end)) as kept_sha256
from kept
"""


@query("op4_remove_repeats", OP4_SQL)
def op4_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query("op5_encode_bytes")
def op5_encode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_cross_parse")
def op6_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


@query("op7_find_personal_data")
def op7_find_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [k.name for k in pii.BASE]
    of = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    return found.select(
        "doc_id",
        *[of(name) for name in base],
        sha256_hex(pii.span_list(F.filter("spans", lambda s: s["kind"].isin(base)))).alias("base_sha256"),
        pii.span_list(F.col("spans")).alias("spans"),
    )


OP8_SQL = """
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), seen as (
  select *, row_number() over w as n, lag(role) over w as prior from rows_
  window w as (partition by conv_id order by turn, role, text)
), sized as (
  select *, prior is null or prior <> role as opens,
    length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), ']', '&#93;')) as own,
    length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), ']', '&#93;')) as head
  from seen
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
  sum(own + case when opens then head + 10 else 6 end)::bigint as formatted_chars
from sized group by conv_id
"""


@query("op8_format_chats", OP8_SQL)
def op8_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    chats = chat.format_chats(turns.unionByName(own))
    read = chats.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(listed).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        sha256_hex(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select *, min(page_id) over (partition by payload_digest) as first_id from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from f
"""


@query("op9_zip_archives", OP9_SQL)
def op9_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = wacz.archive_folder(pages)
    read = wacz.read_archives(wacz.write_archives(pages, folder), folder)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), shingled as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words
), sets as (
  select s, min(doc_id) as node, len(s) as n from (select doc_id, list_sort(s) as s from shingled where len(s) > 0) group by s
), terms as materialized (select node, n, unnest(s) as t from sets),
pairs as (
  select a.node as x, b.node as y from terms a join terms b on a.t = b.t and a.node < b.node
  and b.n >= 0.85 * a.n and a.n >= 0.85 * b.n
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges as materialized (
  select x, y from pairs union all select y, x from pairs
  union all select d.doc_id, t.node from shingled d join sets t on list_sort(d.s) = t.s
  union all select t.node, d.doc_id from shingled d join sets t on list_sort(d.s) = t.s
), reach as (
  select doc_id, doc_id as r from documents
  union select reach.doc_id, edges.y from reach join edges on reach.r = edges.x
)
select doc_id, len(s)::bigint as n_shingles, c as component_id, doc_id = c as kept
from shingled join (select doc_id, min(r) as c from reach group by doc_id) using (doc_id)
"""


@query("op10_near_duplicates", OP10_SQL)
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query("op11_hilbert_shards")
def op11_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of equal counts along a curve through language, source and size; texts are not shuffled."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty("text").cast("binary")).alias("text_crc32"),
    )
    found = hilbert.shards(docs, 16, ("lang", "source"), ("size",), ("doc_id", "text_crc32"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


OP12_SQL = """
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), runs as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase, count(*) as a
  from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from runs, (values (1), (2), (3), (4)) t(size) where len(w) >= size)
  group by all
), totals as (select lang, sum(a)::bigint as n from grams where size = 1 group by lang),
frequent as materialized (select * from grams where a >= 30),
cuts as (
  select *, array_to_string(p[1:k], ' ') as x, array_to_string(p[k + 1:size], ' ') as y
  from (select *, unnest(range(1, size)) as k from (select *, string_split(phrase, ' ') as p from frequent where size > 1))
), scored as (
  select c.lang, c.size, c.phrase, c.a, l.a as l, r.a as r, (2000000::hugeint * c.a) // (l.a + r.a) as score,
    row_number() over (partition by c.lang, c.phrase order by (2000000::hugeint * c.a) // (l.a + r.a), k) as best
  from cuts c join frequent l on l.lang = c.lang and l.phrase = c.x join frequent r on r.lang = c.lang and r.phrase = c.y
), inner_ as (
  select lang, array_to_string(p[i:i + n - 1], ' ') as phrase, max(a) as longer
  from (select *, unnest(range(1, size - n + 2)) as i
        from (select *, string_split(phrase, ' ') as p from frequent where size > 2), (values (2), (3)) t(n) where n < size)
  group by all
), free as (
  select s.* from scored s left join inner_ i on i.lang = s.lang and i.phrase = s.phrase
  where best = 1 and (longer is null or 100 * longer < 80 * s.a)
), ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from free)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = """
with rows_ as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), marks as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
), checked as (
  select part, coalesce(good, 0) as good, coalesce(m.toxic, 0) as toxic,
    (len(w) < 200)::int as a, (100 * len(list_distinct(w)) < 50 * len(w))::int as b,
    (100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(text))::int as c,
    regexp_matches(text, '[#$%&*|]')::int as d,
    coalesce(r.doc_id > min(r.doc_id) over (partition by text), false)::int as e
  from rows_ r left join marks m on r.doc_id = m.doc_id
), failing as (
  select part, good, toxic, [a, b, c, d, e] as f, a + b + c + d + e as fails from checked
), letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest(range(1, 6)) as i),
orders as (
  select o.x || p.x || q.x || r.x || s.x as filter_order, [o.i, p.i, q.i, r.i, s.i] as pos
  from letters o, letters p, letters q, letters r, letters s
  where len(list_distinct([o.i, p.i, q.i, r.i, s.i])) = 5
), cells as (select part, f, fails, count(*) as docs, sum(good) as good, sum(toxic) as toxic from failing group by all),
steps as (
  select part, filter_order, step, pos[step] as own, list_sum(list_transform(pos[:step - 1], lambda j: f[j])) as before,
    f[pos[step]] as now, fails, docs, good, toxic
  from cells, orders, (select unnest(range(1, 6)) as step)
), counted as (
  select part, filter_order, step, own,
    coalesce(sum(docs) filter (coalesce(before, 0) = 0 and now = 0), 0)::bigint as kept,
    coalesce(sum(docs) filter (coalesce(before, 0) = 0 and now = 1), 0)::bigint as removed,
    coalesce(sum(docs) filter (before > 0 and now = 1), 0)::bigint as redundant,
    coalesce(sum(docs) filter (now = 1 and fails = 1), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (coalesce(before, 0) = 0 and now = 1), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (coalesce(before, 0) = 0 and now = 1), 0)::bigint as toxic_lost
  from steps group by all
)
select * exclude (own), sum(removed) over (partition by part, own)::bigint as shapley from counted
"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
