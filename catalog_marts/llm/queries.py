"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.llm.alignment import align_tokenizers
from catalog_marts.llm.bpe import bpe_encode
from catalog_marts.llm.chat import link_calls
from catalog_marts.llm.curriculum import mix_sources
from catalog_marts.llm.divergence import source_divergence
from catalog_marts.llm.lines import deduplicate_lines
from catalog_marts.llm.minmax import near_duplicates
from catalog_marts.llm.mtree import top_products
from catalog_marts.llm.multi_index import near_duplicate_vectors
from catalog_marts.llm.packing import pack_sequences
from catalog_marts.llm.phrases import remove_repeats
from catalog_marts.llm.text import WORD
from catalog_marts.llm.toxicity import toxicity
from catalog_marts.llm.warc import read_warc, write_warc
from catalog_marts.sources import scratch_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_QUESTION = {
    "type": "object",
    "required": ["query", "words"],
    "properties": {
        "query": {"type": "string", "minLength": 1},
        "words": {"type": "integer", "minimum": 1, "maximum": 64},
        "after": {"type": "array", "items": {"type": "string"}},
    },
    "additionalProperties": False,
}


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user or system turn as a call that refers to the turn two before, and every assistant
    turn as the result of the turn before it.
    """
    turns = _read(spark, sf_dir, "conversations")
    name = lambda turn: F.concat_ws(":", F.lit("call"), "conv_id", turn)
    refs = F.when(F.col("turn") >= 2, F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    words = F.regexp_count("text", F.lit(WORD))
    calls = turns.where("role <> 'assistant'").select(
        F.col("conv_id").alias("conv"), name(F.col("turn")).alias("id"), F.col("turn").alias("position"),
        F.col("role").alias("name"), refs.alias("refs"),
        F.to_json(F.struct(F.col("text").alias("query"), words.alias("words"), refs.alias("after"))).alias("arguments"),
    )
    results = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), name(F.col("turn") - 1).alias("id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )
    return link_calls(calls, results, {"user": _QUESTION, "system": _QUESTION}).select(
        F.col("conv").alias("conv_id"), "level", "position", F.col("id").alias("call_id"), F.col("name").alias("tool"),
        "status", F.concat_ws("; ", "errors").alias("errors"), F.sha2(F.col("record").cast("binary"), 256).alias("record_sha256"),
    )


_OP1 = r"""
with calls as (
  select conv_id, turn, role, text, 'call:' || conv_id || ':' || turn as id,
    case when turn >= 2 then 'call:' || conv_id || ':' || (turn - 2) end as ref,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
  from conversations where role <> 'assistant'),
results as (
  select conv_id, 'call:' || conv_id || ':' || (turn - 1) as id, turn, text as content
  from conversations where role = 'assistant'),
runs as (
  select *, turn - 2 * row_number() over (partition by conv_id, turn % 2 order by turn) as run from calls),
levels as (
  select *, row_number() over (partition by conv_id, turn % 2, run order by turn) - 1 as level from runs),
linked as (
  select coalesce(c.conv_id, r.conv_id) as conv_id, c.level, coalesce(c.turn, r.turn) as position,
    coalesce(c.id, r.id) as call_id, c.role as tool, c.text, c.words, c.ref, r.content, c.id is not null as called,
    case when c.words < 1 then '$.words: below minimum' when c.words > 64 then '$.words: above maximum' end as bad_words,
    case when c.text = '' then '$.query: too short' end as bad_query,
    case when c.ref is not null and not exists (from calls d where d.id = c.ref) then 'unknown call ' || c.ref end as lost
  from levels c full join results r on c.id = r.id)
select conv_id, cast(level as bigint) as level, position, call_id, tool,
  case when not called then 'no call' when concat_ws('; ', bad_query, bad_words, lost) <> '' then 'invalid'
    when content is null then 'no result' else 'ok' end as status,
  concat_ws('; ', bad_query, bad_words, lost) as errors,
  sha256(case when called then '{"arguments":{"after":[' || coalesce('"' || ref || '"', '') || '],"query":' || to_json(text)
      || ',"words":' || words || '},"id":"' || call_id || '","name":"' || tool || '","result":' || coalesce(to_json(content), 'null') || '}'
    else '{"id":"' || call_id || '","result":' || to_json(content) || '}' end) as record_sha256
from linked"""


def op2_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(_read(spark, sf_dir, "embeddings"), every=20, k=20, scale=64)


_OP2 = """
with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from usable q join usable c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), words=2)


def op5_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_warc(_read(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select(
        F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("bigint").alias("refers_to"),
    )


_OP5 = """
with hashed as (
  select page_id, strlen(coalesce(html, '')) as bytes, sha1(coalesce(html, '')) as h from pages),
coded as (
  select *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      cast(cast('0x' || substr(h, cast(5 * (i // 4) + 1 as int), 5) as bigint) >> cast(5 * (3 - i % 4) as int) & 31 as int) + 1, 1)), '') as code,
    max(page_id) over (partition by h) as last_id
  from hashed)
select page_id, cast(bytes as bigint) as payload_bytes, code as payload_digest,
  case when page_id = last_id then 'response' else 'revisit' end as record_type,
  case when page_id = last_id then null else last_id end as refers_to
from coded"""


def token_digest(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Number of ids of every text, digests of the ids and of the bytes that they decode to.

    One task encodes and decodes: two Python steps in a row would take a worker each.
    """
    return bpe_encode(docs, ranks, pattern, decoded=True).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(_read(spark, sf_dir, "documents"))


def op7_multi_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_read(spark, sf_dir, "embeddings"))


_OP7 = """
with recursive usable as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.93),
reached(vec_id, other) as (
  select vec_id, vec_id from embeddings
  union
  select r.vec_id, l.b from reached r join links l on r.other = l.a)
select vec_id, cast((select count(*) from links where a = vec_id) as bigint) as n_links,
  min(other) as component_id, min(other) = vec_id as kept
from reached group by vec_id"""


def op8_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted by the time of the first use."""
    mixed = mix_sources(_read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.size("positions").cast("bigint").alias("uses"),
        F.round(F.get("positions", F.lit(0)), 9).alias("first_position"),
    ).orderBy("first_position", "doc_id")


_OP9 = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
  from documents),
per_source as (
  select *, row_number() over (order by source nulls last) - 1 as pos
  from (select source, cast(sum(size) as bigint) as source_size from sized group by source)),
capped as (
  select *, cast(pos % 3 + 1 as bigint) as w, 3 * source_size as cap from per_source),
levels as (
  select *, cast((sum(source_size) over ()
      - coalesce(sum(cap) over (order by cap / w, pos rows between unbounded preceding and 1 preceding), 0))
      as bigint) / cast(sum(w) over (order by cap / w, pos rows between current row and unbounded following)
      as bigint) as lvl
  from capped),
marked as (select *, cap <= lvl * w as stops from levels),
goals as (
  select source, source_size, pos, case when stops then cast(cap as double)
    else max(case when not stops then lvl end) over () * w end as target
  from marked),
ordered as (
  select *, cast(coalesce(sum(size) over (partition by source order by md5(coalesce(cast(doc_id as varchar), '')), size
    rows between unbounded preceding and 1 preceding), 0) as bigint) as start
  from sized),
uses as (
  select doc_id, size, source_size, target, pos, start / target as share,
    greatest(least(cast(round(target) as bigint) - start, size), 0) as t0,
    greatest(least(cast(round(target) as bigint) - start - source_size, size), 0) as t1,
    greatest(least(cast(round(target) as bigint) - start - 2 * source_size, size), 0) as t2
  from ordered join goals on ordered.source is not distinct from goals.source)
select doc_id, size, source_size, target, t0 + t1 + t2 as taken,
  (t0 > 0)::bigint + (t1 > 0)::bigint + (t2 > 0)::bigint as uses,
  case when t0 <= 0 then null else round(case
    when pos % 3 = 0 then 2 * share / (1.5 + sqrt(greatest(2.25 - 2 * share, 0)))
    when pos % 3 = 1 then 2 * share / (0.5 + sqrt(0.25 + 2 * share))
    when share < 0.5 then 2 * share / (0.5 + sqrt(0.25 + 4 * share))
    else 0.5 + 2 * (share - 0.5) / (1.5 + sqrt(greatest(2.25 - 4 * (share - 0.5), 0))) end, 9) end as first_position
from uses"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 0.8 similarity with an earlier line removed; the digest is of what is left."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicate_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op11_identity_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(docs, *files, keep_groups=False)[0].drop("groups")


def op12_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_iceberg_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(_read(spark, sf_dir, "documents"))


_OP13 = r"""
with docs as (
  select row_number() over () as id, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source
  from documents),
occurrences as (
  select id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from docs),
kept as (select lang, term from occurrences group by lang, term having count(distinct id) >= 30),
sizes as (select lang, count(*) as v from kept group by lang),
counts as (
  select lang, source, term, count(*) as n from occurrences semi join kept using (lang, term) group by lang, source, term),
totals as (
  select g.lang, g.source, coalesce(t.total, 0)::hugeint as total, coalesce(s.v, 0)::hugeint as v
  from (select distinct lang, source from docs) g
  left join (select lang, source, sum(n) as total from counts group by lang, source) t using (lang, source)
  left join sizes s using (lang)),
shares as (
  select t.lang, t.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (t.total + 5 * t.v) as p
  from totals t join kept k using (lang) left join counts c using (lang, source, term)),
whole as (
  select lang, term, 1 + (1000000000::hugeint * (sum(n) + 5)) // (any_value(total) + 5 * any_value(v)) as q
  from shares join (select lang, sum(total) as total, any_value(v) as v from totals group by lang) using (lang)
  group by lang, term),
far as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from shares a join shares b using (lang, term) where a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
  from totals a join totals b on a.lang = b.lang and a.source <> b.source
  left join far f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (
  select s.lang, s.source, 'term' as part, s.term as item, s.p - w.q as value
  from shares s join whole w using (lang, term) where s.n > 0 and s.p > w.q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank
from ranked where part = 'pair' or rank <= 50"""


def queries() -> dict:
    return {
        "op1_tool_calls": op1_tool_calls,
        "op2_mtree_topk": op2_mtree_topk,
        "op3_toxicity": op3_toxicity,
        "op4_minmax_dedup": op4_minmax_dedup,
        "op5_warc_chain": op5_warc_chain,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_multi_index_dedup": op7_multi_index_dedup,
        "op8_phrase_automata": op8_phrase_automata,
        "op9_curriculum_mix": op9_curriculum_mix,
        "op10_line_dedup": op10_line_dedup,
        "op11_identity_alignment": op11_identity_alignment,
        "op12_bin_slack_packing": op12_bin_slack_packing,
        "op13_iceberg_divergence": op13_iceberg_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_tool_calls": _OP1,
        "op2_mtree_topk": _OP2,
        "op5_warc_chain": _OP5,
        "op7_multi_index_dedup": _OP7,
        "op9_curriculum_mix": _OP9,
        "op13_iceberg_divergence": _OP13,
    }
