"""Queries of the operators over whole tables, and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers
from . import chat, decontam, exactdup, langid, mixing, neardup, ppm, sharding, tokens, toxicity
from .common import fold


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return readers.table(spark, sf_dir, table)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontam.decontaminate(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = langid.fit(spark, docs.filter(fold("doc_id", 5) != 0))
    return langid.identify(spark, docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_output(spark, _read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    weights = toxicity.fit(spark, docs, _read(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    return toxicity.score(spark, docs, weights).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, _read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    got = ppm.lm_scores(spark, docs, docs.filter(fold("doc_id", 7) != 2))
    return got.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(r"""select -7L as conv_id, id as turn, if(id = 0, 'user', 'assistant') as role, r'\### Assistant: </turn> ok' as text from range(2)""")
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    got = chat.format_trees(spark, chat.from_turns(spark, turns))
    read = chat.parse(F.col("formatted"))
    digest = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    got = got.withColumn("_turns", read).withColumn("_loss", chat.masked(F.col("formatted"), F.col("loss_spans")))
    conv = F.when(F.col("tree") == "null", None).otherwise(F.substring("tree", 2, 40)).cast("long")
    return got.select(
        conv.alias("conv_id"), F.size("_turns").cast("long").alias("n_turns"), F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_dedup(spark, _read(spark, sf_dir, "documents"), width=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_dedup(_read(spark, sf_dir, "documents"))


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.minimax_shards(spark, _read(spark, sf_dir, "documents"), 8)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op5: sizes and targets, without the rounding's choice of documents."""
    return op5_mix_sources(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op6: counts and the word baseline, without the model's score."""
    return op6_lm_score(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


def queries() -> dict:
    ops = (op1_decontaminate, op2_language_id, op3_token_shards, op4_toxicity, op5_mix_sources, op6_lm_score, op7_chat_format, op8_near_dedup, op9_exact_dedup, op10_shard)
    return {f.__name__: f for f in (*ops, mix_targets, lm_base_scores)}


# The table of the usual crc32, made by its rule, and the crc32 of a text over it.
CRC_TABLE = "tab as (select list(c order by i) as tab from (select i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) as r(i)))"


def _crc(text: str) -> str:
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: cast('0x' || x as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


def _greedy(rows: str, shards: int = 8) -> str:
    """rows with p0, p1, ...: where each shard ends, among sums, if it takes all that fits in cap."""
    for i in range(shards):
        before = f"p{i - 1}" if i else "0"
        rows = f"(select *, coalesce(list_max(list_filter(sums, lambda x: x <= {before} + cap)), {before}) as p{i} from {rows})"
    return rows


ORACLE = {
    "op1_decontaminate": r"""
with d as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
b as (
  select coalesce(cast(item_id as varchar), '') as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
win as (
  select distinct item, least(len(w), 10) as k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as s
  from b, unnest(generate_series(1, greatest(1, len(w) - 9))) as g(i) where len(w) > 0),
ks as (select distinct k from win),
pos as (
  select r, i, k, array_to_string(w[i : i + k - 1], ' ') as s
  from d, ks, unnest(generate_series(1, len(w) - k + 1)) as g(i) where len(w) >= k),
occ as (select r, i, k, item from pos join win using (k, s)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + k - 1)) as p from occ) group by r),
it as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from occ) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join it using (r)""",
    "op7_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), ':', '')) as rl,
    length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', '')) as tl from t),
g as (
  select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '') as loss, sum(rl + tl + 14) as formatted_chars
  from e group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars from g""",
    "op8_near_dedup": r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as g from d, unnest(generate_series(1, greatest(1, len(w) - 1))) as t(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (g) where a.doc_id < b.doc_id group by all),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
e as (select x, y from l union all select y, x from l),
r as (select doc_id as x, doc_id as y from documents union select r.x, e.y from r join e on r.y = e.x)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id, d.doc_id = m.c as kept
from d left join n using (doc_id) join (select x as doc_id, min(y) as c from r group by x) m using (doc_id)""",
    "op9_exact_dedup": r"""
with n as (select doc_id, row_number() over (order by doc_id) as r, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by doc_id nulls last, r) = 1 as kept, sha256(t) as text_sha256 from n""",
    "op10_shard": f"""
with recursive {CRC_TABLE},
d as (select doc_id, coalesce(text, '') as t from documents),
u as (select t, min(doc_id) as gid, sum(strlen(t) + 1) as size, sha256(t) as key from d group by t),
c as (select t, gid, key, {_crc("t")} as crc, size, sum(size) over (order by gid nulls first, key rows unbounded preceding) as s from u, tab),
l as (select list(s order by s) as sums, max(s) as total, max(size) as largest, cast(ceil(max(s) / 8) as hugeint) as even from c),
b(low, high) as (
  select greatest(largest, even), even + largest from l
  union all
  select case when p7 = total then low else cap + 1 end, case when p7 = total then cap else high end
  from {_greedy("(select low, high, (low + high) // 2 as cap, sums, total from b, l where low < high)")}),
e as (select [p0, p1, p2, p3, p4, p5, p6] as cuts from {_greedy("(select high as cap, sums, total from b, l where low = high)")}),
s as (select c.*, len(list_filter(cuts, lambda x: x < s)) as shard from c, e)
select doc_id, cast(strlen(t) + 1 as bigint) as size, cast(crc as bigint) as text_crc32, 'bytes' as law, cast(shard as int) as shard,
  row_number() over (partition by shard order by gid nulls first, key, doc_id nulls first) - 1 as slot, cast(null as int) as grown_shard
from d join s using (t)""",
    "mix_targets": r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
w as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from (select source, cast(sum(size) as bigint) as source_size from d group by source)),
f as (
  select *, sum(2 * source_size) over o - 2 * source_size as capped, sum(w) over () - sum(w) over o + w as free, 1.5 * sum(source_size) over () as total
  from w window o as (order by 2 * source_size / w, source nulls last rows unbounded preceding)),
r as (select max((total - capped) / free) as rate from f)
select doc_id, size, source_size, round(least(2.0 * source_size, w * rate), 6) as target from d join w on d.source is not distinct from w.source, r""",
    "lm_base_scores": f"""
with {CRC_TABLE},
d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') || [' '] as w, {_crc("coalesce(cast(doc_id as varchar), '')")} % 7 = 2 as held_out from documents, tab),
t as (select row_number() over () as r, * from d),
e as (select r, held_out, unnest(w) as word from t),
k as (select word, count(*) as c from e where not held_out group by word),
n as (select sum(c) as n, count(*) as v from k),
s as (select r, count(*) as n_tokens, count(c) as n_known, sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) as base from e left join k using (word), n group by r)
select doc_id, held_out, n_tokens, n_known, cast(n as bigint) as train_tokens, round(base, 6) as base_score from t join s using (r), n""",
}
