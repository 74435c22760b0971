"""The thin queries ``op<N>_<name>`` over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import common as C
from aerolith.llm import hard_negatives, merkle, packing
from aerolith.llm.decontam import contaminated
from aerolith.llm.language_model import scores
from aerolith.llm.line_dedup import dedup_lines
from aerolith.llm.mixing import mix, oracle_sql as mixing_sql
from aerolith.llm.near_dup import near_duplicates
from aerolith.llm.passages import repeated_passages
from aerolith.llm.repetition import verdicts
from aerolith.llm.secrets import listed, scan
from aerolith.llm.wavelet import token_files
from aerolith.llm.wrappers import main_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer of the token queries (a file of every machine)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@_query("op2_minhash_near_dedup", """
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words
  from documents),
s as (
  select doc_id, case when len(words) = 0 then []
    when len(words) < 4 then [array_to_string(words, ' ')]
    else list_distinct([array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)]) end as sh
  from w),
e as (select doc_id, unnest(sh) as g, len(sh) as n from s),
p as (
  select x.doc_id as a, y.doc_id as b, count(*) as both_, any_value(x.n + y.n) as total
  from e x join e y on x.g = y.g and x.doc_id <> y.doc_id group by all),
l as (select a, b from p where 100 * both_ >= 80 * (total - both_)),
r(doc_id, seen) as (
  select doc_id, doc_id from documents
  union select r.doc_id, l.b from r join l on l.a = r.seen),
c as (select doc_id, min(seen) as component_id from r group by doc_id)
select s.doc_id, len(sh)::bigint as n_shingles, component_id, s.doc_id = component_id as kept
from s join c using (doc_id)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents"), shingle=4, percent=80)


@_query("op10_suffix_repetition")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(C.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_covered", "longest_repeat")


@_query("op7_mph_line_dedup", r"""
with l as (
  select doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as i
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))),
k as (
  select key, max(doc_id) as keeper from l where length(key) >= 40
  group by key having count(distinct doc_id) >= 5),
d as (
  select l.*, k.keeper is not null and k.keeper <> l.doc_id as gone
  from l left join k using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from d group by doc_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(C.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query("op3_wavelet_tokens")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(C.table(spark, sf_dir, "documents"), tokenizer_path()).drop("file")


@_query("op9_raking_mix", mixing_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(C.table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept")


@_query("op1_markov_secrets")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(C.table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(kind).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed("assign", "access", "hex"), 256).alias("base_sha256"),
        listed("assign", "access", "hex", "markov").alias("spans"), count("markov"))


@_query("op4_cgk_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


@_query("op8_compact_windows")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(C.table(spark, sf_dir, "documents"))


@_query("op5_gru_scores")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(C.table(spark, sf_dir, "documents"))


@_query("op6_inferred_wrappers")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(C.table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query("op11_rtree_negatives", """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
    list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (
  select * from s where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.id as positive_id,
  row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id)::int as rank,
  n.id as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.anchor_id = p.anchor_id and not n.same
  and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
        .otherwise(F.col("label")))
    return hard_negatives.mine(spark, rows, F.col("vec_id") % 100 == 0)


_FIELD = "coalesce(octet_length(encode({0}::varchar))::varchar || ':' || {0}::varchar, '-')"


@_query("op12_subtree_manifest", r"""
with recursive d as (
  select doc_id, source, lang, n_chars, text,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
          string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
          lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 3 = 0 as hit
  from documents),
a as (
  select *, case when hit then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                         'abcdefghijklmnopqrstuvwxyz') else text end as other
  from d),
f as (
  select doc_id, lang, sha256(""" + " || ".join(
    _FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + r""") as leaf,
    sha256(""" + " || ".join(
    _FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "other")) + r""") as second
  from a),
o as (
  select *, row_number() over (partition by lang order by doc_id, leaf, second) - 1 as i from f),
t as (
  select lang, 0 as level, i, leaf as h, count(*) over (partition by lang) as n from o
  union all
  select lang, level + 1, i // 8, sha256(string_agg(h, '' order by i)), any_value((n + 7) // 8)
  from t where n > 1 group by lang, level, i // 8),
s as (
  select lang, h as subroot, level as height, row_number() over (order by lang nulls first) - 1 as g
  from t where n = 1),
u as (
  select 0 as level, g as i, subroot as h, count(*) over () as n from s
  union all
  select level + 1, i // 8, sha256(string_agg(h, '' order by i)), any_value((n + 7) // 8)
  from u where n > 1 group by level, i // 8),
z as (
  select lang, level as step, t.i, (select string_agg(b.h, '' order by b.i) from t b
      where b.lang is not distinct from t.lang and b.level = t.level and b.i // 8 = t.i // 8
        and b.i < t.i) as l,
    (select string_agg(b.h, '' order by b.i) from t b
      where b.lang is not distinct from t.lang and b.level = t.level and b.i // 8 = t.i // 8
        and b.i > t.i) as r
  from t where n > 1
  union all
  select s.lang, s.height + u.level, s.g, (select string_agg(b.h, '' order by b.i) from u b
      where b.level = u.level and b.i // 8 = u.i // 8 and b.i < u.i),
    (select string_agg(b.h, '' order by b.i) from u b
      where b.level = u.level and b.i // 8 = u.i // 8 and b.i > u.i)
  from s join u on u.n > 1 and u.i = s.g // (8 ** u.level)::bigint),
w as (
  select doc_id, leaf, lang, i, 0 as step, second as h, '' as proof from o
  union all
  select w.doc_id, w.leaf, w.lang, w.i, w.step + 1,
    sha256(coalesce(z.l, '') || w.h || coalesce(z.r, '')),
    w.proof || coalesce(z.l, '') || coalesce(z.r, '')
  from w join s on s.lang is not distinct from w.lang
  join z on z.lang is not distinct from w.lang and z.step = w.step
    and z.i = case when w.step < s.height then w.i // (8 ** w.step)::bigint else s.g end)
select w.doc_id, w.leaf, s.subroot, r.h as root, sha256(w.proof) as proof_sha256,
  w.h as folded_root, w.h = r.h as verified
from w join s on s.lang is not distinct from w.lang
join (select h, level from u where n = 1) r on w.step = s.height + r.level""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.manifest(
        C.table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
        "doc_id", "lang", {"text": lowered},
        F.crc32(F.col("doc_id").cast("string")) % 3 == 0).drop("lang")


@_query("op13_open_windows")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_report(packing.pack(
        C.table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))
