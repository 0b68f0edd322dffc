"""Queries of the library by name, with the SQL that gives the same rows."""

import random
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import models
from ..functions import text as T
from ..functions import tokens as K
from ..operators import context, corpus, feedback, metrics, results
from ..sources import readers

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return readers.table(spark, sf_dir, table)


def _fresh(spark: SparkSession, name: str) -> str:
    """A new name for a table of a query; what an earlier run of this session has left is dropped. Another session
    with the same warehouse may still use its own."""
    for t in spark.catalog.listTables(pattern=f"sparkloom_{name}_*"):
        spark.sql(f"drop table {t.name}")
    return f"sparkloom_{name}_{uuid.uuid4().hex}"


# Lines of documents, some turned into comments and the like, as real corpora have them.
LINES = """
raw as (select doc_id, i - 1 as line_no, p[i] as line from (select doc_id, string_split(text, chr(10)) as p from documents), unnest(generate_series(1, len(p))) as g(i)),
lines as (select doc_id, line_no, case (doc_id + line_no) % 7 when 0 then '# ' when 1 then '// ' when 2 then '  ;' when 3 then 'RVTEST_' else '' end || line || case when (doc_id + line_no) % 5 = 0 then ' # note' else '' end as line from raw)"""
STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
CLEAN = rf"""
clean as (select doc_id, line_no, s as line from (select *, {STRIP.format("line")} as s from lines) where s <> '' and not regexp_matches(s, '^(#|//|;|TEST|RVTEST)'))"""
OPCODES = rf"""
codes as (select doc_id, line_no, regexp_extract(c, '^\s*(\S+)', 1) as opcode from (select *, {STRIP.format("split_part(line, '#', 1)")} as c from clean) where c <> ''),
counts as (select opcode, count(*) as n, min((doc_id, line_no)) as first_seen from codes group by opcode)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = corpus.lines(_read(spark, sf_dir, "documents"))
    m = (F.col("doc_id") + F.col("line_no")) % 7
    head = F.when(m == 0, "# ").when(m == 1, "// ").when(m == 2, "  ;").when(m == 3, "RVTEST_").otherwise("")
    tail = F.when((F.col("doc_id") + F.col("line_no")) % 5 == 0, " # note").otherwise("")
    return rows.withColumn("line", F.concat(head, "line", tail))


@query(f"with {LINES},{CLEAN} select doc_id, cast(line_no as bigint) as line_no, line from clean")
def q01_clean_lines(spark, sf_dir):
    return corpus.clean_lines(_lines(spark, sf_dir)).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


def _opcode_top(spark, sf_dir, k):
    counts = corpus.count_by(corpus.opcodes(corpus.clean_lines(_lines(spark, sf_dir))), "opcode", ["doc_id", "line_no"])
    return corpus.most_common(counts, k).select("opcode", "n")


@query(f"with {LINES},{CLEAN},{OPCODES} select opcode, n from counts order by n desc, first_seen limit 10")
def q02_opcode_top10(spark, sf_dir):
    return _opcode_top(spark, sf_dir, 10)


@query(f"with {LINES},{CLEAN},{OPCODES} select opcode, n from counts order by n desc, first_seen limit 15")
def q03_opcode_top15(spark, sf_dir):
    return _opcode_top(spark, sf_dir, 15)


TOKENS = r"docs as (select doc_id, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') as t from documents)"
IDS = "ids as (select doc_id, list_transform(t, lambda x: cast('0x' || substr(md5(x), 1, 6) as int)) as ids from docs)"


@query(f"with {TOKENS}, e as (select doc_id, i - 1 as pos, t[i] as token from docs, unnest(generate_series(1, len(t))) as g(i)) select token, count(*) as n from e group by token order by n desc, min((doc_id, pos)) limit 10")
def q04_token_top10(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.posexplode(K.whitespace_tokens(F.col("text"))).alias("pos", "token"))
    return corpus.most_common(corpus.count_by(docs, "token", ["doc_id", "pos"]), 10).select("token", "n")


@query("select lang, count(*) as n, case when count(*) < 150 then 'SAMPLE' else 'FULL' end as size_class from documents group by lang")
def q05_split_counts(spark, sf_dir):
    return _read(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")).withColumn("size_class", corpus.size_class(F.col("n"), 150))


def _turn_pairs(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("prefix"), F.lead("text", 1, "").over(w).alias("suffix"), F.lead("text", 2, "").over(w).alias("reference"))
    return rows.filter("role = 'user'").drop("role")


PAIRS = "pairs as (select * exclude role from (select conv_id, turn, role, text as prefix, lead(text, 1, '') over w as suffix, lead(text, 2, '') over w as reference from conversations window w as (partition by conv_id order by turn)) where role = 'user')"


@query(f"with {PAIRS} select conv_id, turn, '<fim_prefix>' || prefix || '<fim_suffix>' || suffix || '<fim_middle>' as prompt from pairs")
def q06_fim_prompts(spark, sf_dir):
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", T.fim_prompt(F.col("prefix"), F.col("suffix")).alias("prompt"))


@query(f"""with {PAIRS}, e as (select conv_id, turn, case conv_id % 5
  when 0 then '<fim_prefix>' || prefix || '<fim_suffix>' || suffix || '<fim_middle>' || reference
  when 1 then '<fim_prefix>' || prefix || '<fim_prefix><fim_suffix>' || suffix || '<fim_middle>' || reference || '<fim_middle>tail'
  when 2 then '<fim_prefix>' || prefix || '<fim_suffix>' || suffix || '<fim_suffix>more<fim_middle>' || reference
  when 3 then '<fim_middle>' || prefix || '<fim_suffix>' || suffix || '<fim_middle>' || reference
  else '<fim_prefix>' || prefix || '<fim_suffix>' || suffix end as text from pairs),
v as (select *, contains(text, '<fim_suffix>') and contains(text, '<fim_middle>') as valid from e)
select conv_id, turn, valid, case when valid then replace(split_part(text, '<fim_suffix>', 1), '<fim_prefix>', '') end as prefix,
  case when valid then split_part(split_part(text, '<fim_suffix>', 2), '<fim_middle>', 1) end as suffix, case when valid then split_part(text, '<fim_middle>', 2) end as reference from v""")
def q07_fim_parse(spark, sf_dir):
    p, s, m, (a, b, c) = F.lit("<fim_prefix>"), F.lit("<fim_suffix>"), F.lit("<fim_middle>"), (F.col(x) for x in ("prefix", "suffix", "reference"))
    kind = F.col("conv_id") % 5
    text = F.when(kind == 0, F.concat(p, a, s, b, m, c)).when(kind == 1, F.concat(p, a, p, s, b, m, c, m, F.lit("tail"))).when(kind == 2, F.concat(p, a, s, b, s, F.lit("more"), m, c)).when(kind == 3, F.concat(m, a, s, b, m, c)).otherwise(F.concat(p, a, s, b))
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", T.parse_fim(text).alias("e")).select("conv_id", "turn", "e.*")


NORMAL = r"lower(regexp_replace(regexp_replace(regexp_replace({}, '#.*', '', 'g'), '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g'))"


@query(f"select doc_id, md5({NORMAL.format('t')}) as digest from (select doc_id, case doc_id % 3 when 0 then replace(text, '. ', '. #cut ') when 1 then replace(text, ' ', chr(9) || '  ') else text end as t from documents)")
def q08_normalise(spark, sf_dir):
    m, text = F.col("doc_id") % 3, F.col("text")
    noisy = F.when(m == 0, F.replace(text, F.lit(". "), F.lit(". #cut "))).when(m == 1, F.replace(text, F.lit(" "), F.lit("\t  "))).otherwise(text)
    return _read(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalise(noisy)).alias("digest"))


GENERATED = "pairs as (select item_id, text as reference, case item_id % 3 when 0 then text || '  # as asked' when 1 then text || ' and more' else 'nop' end as generated from benchmark)"


def _pairs(spark, sf_dir):
    m, text = F.col("item_id") % 3, F.col("text")
    return _read(spark, sf_dir, "benchmark").select("item_id", text.alias("reference"), F.when(m == 0, F.concat(text, F.lit("  # as asked"))).when(m == 1, F.concat(text, F.lit(" and more"))).otherwise("nop").alias("generated"))


@query(f"with {GENERATED}, n as (select {NORMAL.format('reference')} as r, {NORMAL.format('generated')} as g from pairs) select count(*) as n, round(avg(cast(r = g as int)) * 100, 6) as exact_match_pct, round(avg(cast(starts_with(g, r) as int)) * 100, 6) as prefix_match_pct from n")
def q09_match_report(spark, sf_dir):
    got = metrics.match_report(_pairs(spark, sf_dir))
    return got.select("n", F.round("exact_match_pct", 6).alias("exact_match_pct"), F.round("prefix_match_pct", 6).alias("prefix_match_pct"))


def _bleu_sql(tokens: str) -> str:
    return f"""with {GENERATED}, t as (select item_id, {tokens.format('reference')} as r, {tokens.format('generated')} as h from pairs),
g as (select item_id, n, 'r' as side, array_to_string(r[i : i + n - 1], ' ') as gram from t, unnest([1, 2, 3, 4]) as o(n), unnest(generate_series(1, len(r) - n + 1)) as s(i)
  union all select item_id, n, 'h', array_to_string(h[i : i + n - 1], ' ') from t, unnest([1, 2, 3, 4]) as o(n), unnest(generate_series(1, len(h) - n + 1)) as s(i)),
c as (select item_id, n, gram, count(*) filter (side = 'r') as r, count(*) filter (side = 'h') as h from g group by all),
s as (select n, sum(least(r, h)) as m, sum(h) as t, sum(r) as l from c group by n),
b as (select sum(ln(m / t)) as logs, max(case when n = 1 then l end) as ref_len, max(case when n = 1 then t end) as hyp_len from s)
select cast(ref_len as bigint) as ref_len, cast(hyp_len as bigint) as hyp_len, round(100 * case when hyp_len < ref_len then exp(1 - ref_len / hyp_len) else 1 end * exp(logs / 4), 6) as bleu from b"""


def _bleu(spark, sf_dir, tokens):
    got = metrics.bleu(metrics.bleu_counts(_pairs(spark, sf_dir), "item_id", tokens))
    return got.select("ref_len", "hyp_len", F.round("bleu", 6).alias("bleu"))


@query(_bleu_sql(r"list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> '')"))
def q10_bleu_words(spark, sf_dir):
    return _bleu(spark, sf_dir, K.whitespace_tokens)


@query(_bleu_sql(r"list_filter(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(regexp_replace(' ' || replace({}, chr(10), ' ') || ' ', '([\{{-\~\[-\` -\&\(-\+\:-\@\/])', ' \1 ', 'g'), '([^0-9])([\.,])', '\1 \2 ', 'g'), '([\.,])([^0-9])', ' \1 \2', 'g'), '([0-9])(-)', '\1 \2 ', 'g'), '\s+'), lambda x: x <> '')"))
def q10_bleu_13a(spark, sf_dir):
    return _bleu(spark, sf_dir, metrics.tokens_13a)


LOSSES = "losses as (select event_id, case when event_id % 97 = 0 then 800.0 else value / 100 end as loss, event_id % 10 as ref_len from events)"


def _losses(spark, sf_dir):
    loss = F.when(F.col("event_id") % 97 == 0, 800.0).otherwise(F.col("value") / 100)
    return _read(spark, sf_dir, "events").select("event_id", loss.alias("loss"), (F.col("event_id") % 10).alias("ref_len"))


@query(f"with {LOSSES}, p as (select case when ref_len > 0 and loss < 700 then exp(loss) end as p from losses) select round(avg(p), 6) as avg_perplexity, count(p) as used, count(*) - count(p) as skipped from p")
def q11_perplexity(spark, sf_dir):
    got = metrics.perplexity_report(_losses(spark, sf_dir))
    return got.select(F.round("avg_perplexity", 6).alias("avg_perplexity"), "used", "skipped")


RATINGS = """ratings as (select event_id, case when event_id % 6 = 0 then '' else event_type end as prefix, props as suffix, case when event_id % 11 = 0 then '' else event_type end as suggestion,
  case event_id % 5 when 0 then null when 1 then 0 when 2 then 1 when 3 then 3 else 1 end as rating, case when event_id % 7 = 0 then 'unknown' when event_id % 2 = 0 then 'realtime' else 'comment-to-code' end as suggestion_type,
  event_id % 3 = 0 as accepted, case when event_id % 4 = 0 then '' else '2026-01-0' || (event_id % 9 + 1) || 'T00:00:00.000Z' end as "timestamp" from events)"""
DETAIL = """case when suggestion = '' then 'Suggestion is required' when rating is not null and rating not in (0, 1) then 'Rating must be 0 or 1'
  when suggestion_type not in ('realtime', 'comment-to-code') then 'suggestion_type must be ''realtime'' or ''comment-to-code''' end"""


def _ratings(spark, sf_dir):
    e = F.col("event_id")
    return _read(spark, sf_dir, "events").select(
        "event_id",
        F.when(e % 6 == 0, "").otherwise(F.col("event_type")).alias("prefix"),
        F.col("props").alias("suffix"),
        F.when(e % 11 == 0, "").otherwise(F.col("event_type")).alias("suggestion"),
        F.when(e % 5 == 1, 0).when(e % 5 == 2, 1).when(e % 5 == 3, 3).when(e % 5 == 4, 1).alias("rating"),
        F.when(e % 7 == 0, "unknown").when(e % 2 == 0, "realtime").otherwise("comment-to-code").alias("suggestion_type"),
        (e % 3 == 0).alias("accepted"),
        F.when(e % 4 == 0, "").otherwise(F.concat(F.lit("2026-01-0"), (e % 9 + 1).cast("string"), F.lit("T00:00:00.000Z"))).alias("timestamp"),
    )


def _detail():
    return feedback.rating_detail(F.col("suggestion"), F.col("rating"), F.col("suggestion_type"))


@query(f"with {RATINGS} select event_id, case when d is null then 200 else 400 end as status, d as detail from (select event_id, {DETAIL} as d from ratings)")
def q12_rating_validation(spark, sf_dir):
    return _ratings(spark, sf_dir).select("event_id", feedback.status(_detail()).alias("status"), _detail().alias("detail"))


@query(f"""with {RATINGS} select event_id, cast(accepted as int) as accepted, coalesce(nullif("timestamp", ''), '2026-02-01T00:00:00.000000+00:00') as "timestamp" from ratings where {DETAIL} is null""")
def q13_rating_defaults(spark, sf_dir):
    rows = _ratings(spark, sf_dir).filter(_detail().isNull())
    return feedback.with_defaults(rows, F.lit("2026-02-01T00:00:00.000000+00:00")).select("event_id", "accepted", "timestamp")


@query(f"""with {RATINGS} select prefix, suffix, suggestion, rating, suggestion_type, accepted, "timestamp" from ratings where {DETAIL} is null""")
def q14_rating_scan(spark, sf_dir):
    """Valid ratings are stored in a table, which is read again; times that the table filled in are shown empty."""
    table = _fresh(spark, "q14")
    feedback.init_table(spark, table)
    feedback.save(spark, _ratings(spark, sf_dir).filter(_detail().isNull()).drop("event_id"), table)
    given = F.col("timestamp").rlike("^2026-01-0[1-9]T00:00:00.000Z$")
    return feedback.find_all(spark, table).withColumn("timestamp", F.when(given, F.col("timestamp")).otherwise(""))


@query(f"""with {RATINGS} select event_id as id, prefix, '' as suffix, suggestion, rating, 'realtime' as suggestion_type, 1 as accepted, '' as "timestamp" from ratings where {DETAIL} is null""")
def q15_schema_evolution(spark, sf_dir):
    """A table of the oldest form gets the columns that it lacks; its rows read their defaults."""
    table = _fresh(spark, "q15")
    spark.sql(f"create table {table} (id long, prefix string, suggestion string, rating int) using parquet")
    _ratings(spark, sf_dir).filter(_detail().isNull()).select(F.col("event_id").alias("id"), "prefix", "suggestion", "rating").write.insertInto(table)
    feedback.init_table(spark, table)
    return spark.table(table).drop("request_key")


@query(f"""with {LINES}, w as (select doc_id, line_no, line, cast(length(line) // 2 as int) as cut,
  array_to_string(list(line) over (partition by doc_id order by line_no rows between 40 preceding and 1 preceding), chr(10)) as above,
  array_to_string(list(line) over (partition by doc_id order by line_no rows between 1 following and 20 following), chr(10)) as below from lines),
p as (select doc_id, line_no, regexp_replace(coalesce(above || chr(10), '') || left(line, cut), '^\\s+', '') as prefix, regexp_replace(substr(line, cut + 1) || coalesce(chr(10) || below, ''), '\\s+$', '') as suffix from w)
select doc_id, cast(line_no as bigint) as line_no, cast(length(prefix) as bigint) as prefix_len, md5(prefix) as prefix_md5, cast(length(suffix) as bigint) as suffix_len, md5(suffix) as suffix_md5 from p""")
def q16_context_windows(spark, sf_dir):
    got = context.context_windows(_lines(spark, sf_dir), F.floor(F.length("line") / 2).cast("int"))
    length = lambda c: F.length(c).cast("long").alias(f"{c}_len")
    return got.select("doc_id", F.col("line_no").cast("long").alias("line_no"), length("prefix"), F.md5("prefix").alias("prefix_md5"), length("suffix"), F.md5("suffix").alias("suffix_md5"))


@query(f"""with {LINES}, p as (select doc_id, line_no, coalesce({STRIP.format("lag(line) over (partition by doc_id order by line_no)")}, '') as prev from lines),
k as (select doc_id, line_no, case when starts_with(prev, '#') and length(prev) > 1 then 'comment-to-code' else 'realtime' end as suggestion_type from p)
select doc_id, cast(line_no as bigint) as line_no, suggestion_type, case when suggestion_type = 'comment-to-code' then 150 else 50 end as max_tokens from k""")
def q17_suggestion_type(spark, sf_dir):
    rows = _lines(spark, sf_dir).withColumn("suggestion_type", context.suggestion_type(context.previous_line()))
    return rows.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "suggestion_type", context.token_budget(F.col("suggestion_type")).alias("max_tokens"))


@query(f"with {LINES} select doc_id, count(*) as lines, count(*) filter (regexp_matches({STRIP.format('line')}, '^[#.]')) as suppressed from lines group by doc_id")
def q18_suppression(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(context.suppressed(F.col("line"))).alias("suppressed"))


@query("""with g as (select *, case when ts - lag(ts) over w <= interval 30 minutes then 0 else 1 end as first from events window w as (partition by user_id order by ts, event_id)),
b as (select *, sum(first) over (partition by user_id order by ts, event_id) as burst from g)
select user_id, strftime(max(ts) + interval 30 minutes, '%Y-%m-%d %H:%M:%S') as fires_at, arg_max(event_id, (ts, event_id)) as event_id, count(*) as n from b group by user_id, burst""")
def q19_debounce(spark, sf_dir):
    got = context.debounce(_read(spark, sf_dir, "events"), "user_id", "ts", "event_id", "30 minutes")
    return got.select("user_id", F.date_format("fires_at", "yyyy-MM-dd HH:mm:ss").alias("fires_at"), "event_id", "n")


@query("select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value from events group by user_id")
def q20_latest_request(spark, sf_dir):
    return context.latest(_read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query("select doc_id, case when row_number() over (order by md5(cast(doc_id as varchar)), doc_id) <= ceil(0.2 * (select count(*) from documents)) then 'test' else 'train' end as split from documents")
def q21_train_test_split(spark, sf_dir):
    return corpus.train_test_split(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("select doc_id, row_number() over (order by md5(cast(doc_id as varchar)), doc_id) as sample_pos from documents order by sample_pos limit 200")
def q22_sample(spark, sf_dir):
    return corpus.sample_by_digest(_read(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", F.col("sample_pos").cast("long").alias("sample_pos"))


def _ids(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", K.hash_ids(K.whitespace_tokens(F.col("text"))).alias("ids"))


@query(f"""with {TOKENS}, {IDS} select doc_id, cast(len(ids) as bigint) as n_ids, md5(array_to_string(ids[1:512], ',')) as cut, md5(array_to_string(list_resize(ids[1:512], 512, 0), ',')) as padded from ids""")
def q23_truncate_pad(spark, sf_dir):
    cut = K.truncate(F.col("ids"))
    return _ids(spark, sf_dir).select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.md5(F.array_join(cut.cast("array<string>"), ",")).alias("cut"), F.md5(F.array_join(K.pad(cut).cast("array<string>"), ",")).alias("padded"))


@query(f"""with {TOKENS}, {IDS}, m as (select doc_id, list_transform(ids, lambda x, i: case when i <= doc_id % 50 then -100 else x end) as labels from ids)
select doc_id, md5(array_to_string(labels, ',')) as labels, cast(len(list_filter(labels, lambda x: x = -100)) as bigint) as ignored from m""")
def q24_labels(spark, sf_dir):
    rows = _ids(spark, sf_dir).withColumn("_l", K.mask_prompt(F.col("ids"), F.col("doc_id") % 50))
    return rows.select("doc_id", F.md5(F.array_join(F.col("_l").cast("array<string>"), ",")).alias("labels"), F.size(F.filter("_l", lambda x: x == K.IGNORED)).cast("long").alias("ignored"))


@query("select doc_id, quality, toxic, 'old' as origin from labels where doc_id % 3 <> 0 union all select doc_id, quality + 10, toxic, 'new' from labels where doc_id % 3 = 0 union all select -1, 0, 0, 'new'")
def q25_upsert(spark, sf_dir):
    old = _read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit("old").alias("origin"))
    new = old.filter("doc_id % 3 = 0").withColumn("quality", F.col("quality") + 10).unionByName(spark.createDataFrame([(-1, 0, 0, "old")], old.schema))
    return results.upsert(old, new.withColumn("origin", F.lit("new")), "doc_id")


@query(rf"""with {PAIRS}, g as (select conv_id, turn, prefix, case conv_id % 3 when 0 then prefix || '  ' || suffix || chr(10) when 1 then '  ' || prefix || suffix else suffix end as g from pairs)
select conv_id, turn, {STRIP.format("case when starts_with(g, prefix) then substr(g, length(prefix) + 1) else g end")} as served,
  case when starts_with({STRIP.format("g")}, prefix) then {STRIP.format("substr(" + STRIP.format("g") + ", length(prefix) + 1)")} else {STRIP.format("g")} end as shown from g""")
def q26_completion_strip(spark, sf_dir):
    m, prefix, suffix = F.col("conv_id") % 3, F.col("prefix"), F.col("suffix")
    g = F.when(m == 0, F.concat(prefix, F.lit("  "), suffix, F.lit("\n"))).when(m == 1, F.concat(F.lit("  "), prefix, suffix)).otherwise(suffix)
    rows = _turn_pairs(spark, sf_dir).withColumn("g", g)
    return rows.select("conv_id", "turn", T.after_prompt(F.col("g"), prefix).alias("served"), T.after_prefix(F.col("g"), prefix).alias("shown"))


@query(f"""with {GENERATED}, n as (select item_id, {NORMAL.format('reference')} as r, {NORMAL.format('generated')} as g from pairs),
s as (select item_id, case when not starts_with(g, r) then 'wrong' when g <> r then 'close' end as slice from n)
select item_id, slice from (select *, row_number() over (partition by slice order by item_id) as k from s where slice is not null) where k <= 3""")
def q27_error_slices(spark, sf_dir):
    return metrics.error_slices(_pairs(spark, sf_dir), "item_id").select("item_id", "slice")


@query("""with r as (select doc_id, case when doc_id % 13 = 0 then '' else text end as prefix, doc_id % 4 - 1 as m from documents)
select doc_id, case when d is null then 200 else 400 end as status, d as detail from (select doc_id, case when prefix = '' then 'Prefix is required' when m <= 0 then 'max_new_tokens must be greater than 0' when length(prefix) > 512 then 'Prefix exceeds 512 characters' end as d from r)""")
def q28_generate_validation(spark, sf_dir):
    prefix = F.when(F.col("doc_id") % 13 == 0, "").otherwise(F.col("text"))
    detail = feedback.generate_detail(prefix, F.col("doc_id") % 4 - 1)
    return _read(spark, sf_dir, "documents").select("doc_id", feedback.status(detail).alias("status"), detail.alias("detail"))


@query(f"""with {RATINGS}, q as (select event_id, case when suggestion = '' and event_id % 2 = 0 then 'repaired' else suggestion end as suggestion, case when rating = 3 and event_id % 2 = 0 then 1 else rating end as rating, suggestion_type from ratings where {DETAIL} is not null)
select event_id, case when d is not null then 'parked' when event_id % 8 = 0 then 'duplicate' else 'delivered' end as state, d as detail from (select *, {DETAIL} as d from q)""")
def q29_retry_queue(spark, sf_dir):
    even = F.col("event_id") % 2 == 0
    queue = _ratings(spark, sf_dir).filter(_detail().isNotNull())
    repaired = queue.withColumn("suggestion", F.when((F.col("suggestion") == "") & even, "repaired").otherwise(F.col("suggestion"))).withColumn("rating", F.when((F.col("rating") == 3) & even, 1).otherwise(F.col("rating")))
    stored = _read(spark, sf_dir, "events").filter("event_id % 8 = 0").select("event_id")
    return feedback.flush(repaired, stored, "event_id").select("event_id", "state", "detail")


@query(f"""with {GENERATED}, n as (select {NORMAL.format('reference')} as r, {NORMAL.format('generated')} as g from pairs), {LOSSES}, p as (select case when ref_len > 0 and loss < 700 then exp(loss) end as p from losses)
select (select count(*) from n) as num_samples, (select round(avg(cast(r = g as int)) * 100, 2) from n) as exact_match_pct, (select round(avg(cast(starts_with(g, r) as int)) * 100, 2) from n) as prefix_match_pct, (select round(avg(p), 4) from p) as avg_perplexity, (select count(p) from p) as ppl_sample_size""")
def q30_summary(spark, sf_dir):
    """The summary as JSON, read back: one row of each report, joined as single rows."""
    both = metrics.match_report(_pairs(spark, sf_dir)).withColumn("one", F.lit(1)).join(F.broadcast(metrics.perplexity_report(_losses(spark, sf_dir)).withColumn("one", F.lit(1))), "one")
    body = results.summary_json(
        {"model": F.lit("stub"), "num_samples": F.col("n")},
        {"exact_match_pct": F.round("exact_match_pct", 2), "prefix_match_pct": F.round("prefix_match_pct", 2), "avg_perplexity": F.round("avg_perplexity", 4), "ppl_sample_size": F.col("used")},
    )
    kind = "model string, num_samples long, metrics struct<exact_match_pct double, prefix_match_pct double, avg_perplexity double, ppl_sample_size long>"
    return both.select(F.from_json(body, kind).alias("s")).select("s.num_samples", "s.metrics.*")


@query("""select lang, round(exp(avg(n_chars) / 1000), 6) as perplexity from documents where lang in ('en', 'de') group by lang""")
def q31_dataset_perplexity(spark, sf_dir):
    losses = _read(spark, sf_dir, "documents").groupBy("lang").agg((F.avg("n_chars") / 1000).alias("loss"))
    rows = results.dataset_perplexity(losses.select("lang", F.struct(F.col("loss").alias("eval_loss")).alias("eval_results")))
    return results.pick(rows, "lang", ["en", "de"]).select("lang", F.round("perplexity", 6).alias("perplexity"))


@query("""select event_id, case event_type when 'click' then 1 when 'view' then 0 end as rating, event_id + 1 as line_number from events""")
def q32_feedback_choice(spark, sf_dir):
    choice = F.when(F.col("event_type") == "click", "helpful").when(F.col("event_type") == "view", "not helpful").otherwise("")
    return _read(spark, sf_dir, "events").select("event_id", context.feedback(choice).alias("rating"), (F.col("event_id") + 1).alias("line_number"))


#: Bodies of requests by event_id % 12, with the status, rating and accepted that they get.
BODIES = (
    ('{"prefix":"p","suggestion":"s"}', 200, None, True), ('{"prefix":"p","suggestion":"s","rating":"x"}', 422, None, None),
    ('{"prefix":"p","suggestion":"s","rating":1.5}', 422, None, None), ('{"prefix":"p","suggestion":"s","accepted":"maybe"}', 422, None, None),
    ('{"prefix":"p","suggestion":"s","suffix":null}', 422, None, None), ('{"prefix":5,"suggestion":"s"}', 422, None, None),
    ('{"prefix":"p","suggestion":"s","rating":null}', 200, None, True), ('{"prefix":"p","suggestion":"s","rating":"1","accepted":"no"}', 200, 1, False),
    ("no JSON", 422, None, None), ('["p","s"]', 422, None, None), ('{"prefix":"p"}', 422, None, None), ('{"prefix":"","suggestion":"s","rating":true,"accepted":0}', 200, 1, False),
)


def _sql_case(values: list) -> str:
    return "case event_id % 12 " + " ".join(f"when {i} then {'null' if v is None else v}" for i, v in enumerate(values)) + " end"


@query(f"""select event_id, cast({_sql_case([b[1] for b in BODIES])} as int) as status, cast({_sql_case([b[2] for b in BODIES])} as int) as rating, cast({_sql_case([b[3] for b in BODIES])} as boolean) as accepted,
  case when {_sql_case([b[1] for b in BODIES])} = 200 then 'realtime' end as suggestion_type from events""")
def q33_request_types(spark, sf_dir):
    body = F.element_at(F.array(*[F.lit(b[0]) for b in BODIES]), (F.col("event_id") % 12 + 1).cast("int"))
    record, status = feedback.parse_requests(F.col("body"), schemas.RATING_REQUEST, schemas.RATING_DEFAULTS, schemas.RATING_REQUIRED)
    rows = _read(spark, sf_dir, "events").select("event_id", body.alias("body")).select("event_id", record.alias("r"), status.alias("status"))
    return rows.select("event_id", "status", "r.rating", "r.accepted", "r.suggestion_type")


@query(f"""with {RATINGS} select event_id, case when d is null then '{{"message":"Rating saved"}}' else '{{"detail":"' || d || '"}}' end as body from (select event_id, {DETAIL} as d from ratings)""")
def q34_responses(spark, sf_dir):
    detail = _detail()
    return _ratings(spark, sf_dir).select("event_id", feedback.response(feedback.status(detail), detail, feedback.saved()).alias("body"))


JS_STRIP = r"regexp_replace({}, '^[\t-\r \x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{feff}}]+', '')"


@query(f"""with {LINES}, p as (select doc_id, line_no, line, left(line, cast((doc_id + line_no) % 4 as int)) as prefix, case when line_no % 3 = 0 then '   ' else line end as suggestion from lines)
select doc_id, count(*) filter (not regexp_matches({JS_STRIP.format("line")}, '^[#.]') and {JS_STRIP.format("prefix")} <> '') as asked,
  count(*) filter ((line_no + doc_id) % 2 = 0 and {JS_STRIP.format("suggestion")} <> '') as shown from p group by doc_id""")
def q35_suggestion_filters(spark, sf_dir):
    m = F.col("doc_id") + F.col("line_no")
    rows = _lines(spark, sf_dir).withColumn("prefix", F.substring("line", F.lit(1), (m % 4).cast("int"))).withColumn("suggestion", F.when(F.col("line_no") % 3 == 0, "   ").otherwise(F.col("line")))
    return rows.groupBy("doc_id").agg(
        F.count_if(context.asks(F.col("line"), F.col("prefix"))).alias("asked"),
        F.count_if(context.shown(F.col("suggestion"), F.col("line_no"), F.col("line_no") + m % 2)).alias("shown"),
    )


@query(f"""with {TOKENS}, e as (select doc_id, i - 1 as pos, t[i] as token, cast('0x' || substr(md5(t[i]), 1, 6) as int) as id from docs, unnest(generate_series(1, len(t))) as g(i)),
top as (select id, count(*) as n, min((doc_id, pos)) as first_seen from e group by id order by n desc, first_seen limit 10),
vocabulary as (select id, min(token) as token from e group by id)
select id, n, token from top join vocabulary using (id)""")
def q36_token_ids_top10(spark, sf_dir):
    """Counts of ids; the ten most frequent are looked up in the vocabulary, as are their tokens."""
    tokens = K.whitespace_tokens(F.col("text"))
    pairs = _read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.arrays_zip(K.hash_ids(tokens).alias("id"), tokens.alias("token"))).alias("pos", "t")).select("doc_id", "pos", "t.id", "t.token")
    counts = pairs.groupBy("id").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first_seen"), F.min("token").alias("token"))
    top = corpus.most_common(counts, 10)
    words = top.agg(F.map_from_entries(F.collect_list(F.struct("id", "token"))).alias("vocabulary"))  # ten entries
    return top.select("id", "n").crossJoin(F.broadcast(words)).select("id", "n", K.id_to_token(F.array("id"), F.col("vocabulary"))[0].alias("token"))


@query(f"""with {TOKENS}, {IDS}, c as (select doc_id, ids[1:64] as ids, max(len(ids[1:64])) over (partition by doc_id // 8) as longest from ids),
p as (select doc_id, len(ids) as n, longest, list_resize(ids, longest, 7) as input_ids from c)
select doc_id, cast(longest as int) as longest, md5(array_to_string(input_ids, ',')) as input_ids, cast(n as bigint) as attended, md5(array_to_string(list_transform(input_ids, lambda x: case when x = 7 then -100 else x end), ',')) as labels from p""")
def q37_collate(spark, sf_dir):
    rows = _ids(spark, sf_dir).select("doc_id", F.floor(F.col("doc_id") / 8).alias("batch"), K.truncate(F.col("ids"), 64).alias("ids"))
    got = K.collate(rows, "batch", "ids", 7)
    digest = lambda c: F.md5(F.array_join(F.col(c).cast("array<string>"), ",")).alias(c)
    attended = F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("attended")
    return got.select("doc_id", F.size("input_ids").alias("longest"), digest("input_ids"), attended, digest("labels"))


PLAIN_IDS = r"list_transform(list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> ''), lambda x: cast('0x' || substr(md5(x), 1, 6) as int))"


@query(f"""with {PAIRS} select conv_id, turn, md5(array_to_string([16777216] || {PLAIN_IDS.format("prefix")} || [16777217] || {PLAIN_IDS.format("suffix")} || [16777218], ',')) as ids,
  cast(len({PLAIN_IDS.format("prefix")}) as int) + 1 as suffix_at from pairs""")
def q38_special_tokens(spark, sf_dir):
    markers = ("<fim_prefix>", "<fim_suffix>", "<fim_middle>")
    ids = K.special_tokens(T.fim_prompt(F.col("prefix"), F.col("suffix"), markers), markers, 1 << 24)
    rows = _turn_pairs(spark, sf_dir).select("conv_id", "turn", ids.alias("_ids"))
    return rows.select("conv_id", "turn", F.md5(F.array_join(F.col("_ids").cast("array<string>"), ",")).alias("ids"), (F.array_position("_ids", (1 << 24) + 1) - 1).cast("int").alias("suffix_at"))


@query("""select event_id, case when event_id % 10 = 0 then null when event_id % 2 = 0 then epoch_us(ts) // 1000 * 1000 else epoch_us(ts) end as micros,
  case when event_id % 10 <> 0 then strftime(ts, '%Y%m%d_%H%M%S') end as stamp from events""")
def q39_timestamps(spark, sf_dir):
    """Times written in two formats, or not at all, and read again."""
    ts = F.col("ts").cast("timestamp")
    text = F.when(F.col("event_id") % 10 == 0, "").when(F.col("event_id") % 2 == 0, T.js_timestamp(ts)).otherwise(T.iso_timestamp(ts))
    read = F.try_to_timestamp("text")
    return _read(spark, sf_dir, "events").select("event_id", text.alias("text")).select("event_id", F.unix_micros(read).alias("micros"), T.run_stamp(read).alias("stamp"))


@query(f"""with {RATINGS}, q as (select cast(event_id as varchar) as request_key, {DETAIL} as d from ratings)
select request_key, case when d is null then 'stored' else 'waiting' end as state, cast(case when d is null then 1 else 2 end as bigint) as n from q""")
def q40_retry_queue_drain(spark, sf_dir):
    """Every rating is queued twice; a retry stores valid ones once and leaves the refused rows, and a second one changes nothing."""
    table, queue = _fresh(spark, "q40"), _fresh(spark, "queue")
    feedback.init_table(spark, table)
    feedback.init_queue(spark, queue)
    rows = _ratings(spark, sf_dir).withColumn("request_key", F.col("event_id").cast("string"))
    for _ in range(2):
        feedback.enqueue(spark, rows, queue)
    for _ in range(2):
        feedback.drain(spark, queue, table)
    both = spark.table(table).select("request_key", F.lit("stored").alias("state")).unionByName(spark.table(queue).select("request_key", F.lit("waiting").alias("state")))
    return both.groupBy("request_key", "state").agg(F.count("*").alias("n"))


@query(f"""with {TOKENS}, {IDS}, k as (select doc_id, [x % 1000 / 100 for x, i in ids if i > doc_id % 50] as losses from ids)
select doc_id, round(list_avg(losses), 6) as loss, round(exp(list_avg(losses)), 3) as perplexity from k""")
def q41_mean_loss(spark, sf_dir):
    """Mean loss over the tokens behind the prompt, and its exponential."""
    losses = F.transform("ids", lambda x: (x % 1000) / 100)
    loss = models.mean_loss(losses, K.mask_prompt(F.col("ids"), F.col("doc_id") % 50))
    return _ids(spark, sf_dir).select("doc_id", loss.alias("l")).select("doc_id", F.round("l", 6).alias("loss"), F.round(metrics.perplexity(F.col("l")), 3).alias("perplexity"))


@query("""with m as (select lang, avg(n_chars) / 1000 as loss, sum(n_chars) / 7000 as runtime, count(*) as n, ceil(count(*) / 8) as steps from documents group by lang)
select lang, round(loss, 6) as eval_loss, round(n / runtime, 3) as eval_samples_per_second, round(steps / runtime, 3) as eval_steps_per_second, 'loss: ' || format('{:.4f}', loss) as line from m""")
def q42_evaluation_metrics(spark, sf_dir):
    loss, runtime, n = F.avg("n_chars") / 1000, F.sum("n_chars") / 7000, F.count("*")
    rows = _read(spark, sf_dir, "documents").groupBy("lang").agg(loss.alias("loss"), runtime.alias("runtime"), n.alias("n"))
    row = metrics.metric_row(F.col("loss"), F.col("runtime"), F.col("n"), F.ceil(F.col("n") / 8), F.lit(5.0))
    got = rows.select("lang", row.alias("m"), results.report_line("loss", F.col("loss")).alias("line"))
    return got.select("lang", F.round("m.eval_loss", 6).alias("eval_loss"), "m.eval_samples_per_second", "m.eval_steps_per_second", "line")


@query(f"""with {PAIRS}, n as (select conv_id, turn, len({PLAIN_IDS.format("prefix || ' ' || suffix")}) as p, len({PLAIN_IDS.format("prefix || ' ' || suffix || ' ' || reference")}) as f from pairs)
select conv_id, turn, cast(least(f, 64) - p as int) as ref_len, least(f, 64) - p > 0 as scored from n""")
def q43_reference_window(spark, sf_dir):
    """Reference tokens left in the window of a prompt that is not cut itself; rows without any are not scored."""
    prompt = F.concat_ws(" ", "prefix", "suffix")
    ids = lambda text: K.hash_ids(K.whitespace_tokens(text))
    length = metrics.reference_length(ids(prompt), ids(F.concat_ws(" ", prompt, "reference")), 64)
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", length.alias("ref_len")).select("*", (F.col("ref_len") > 0).alias("scored"))


PICKS = ", ".join(f"({n}, {at + 1}, {place + 1})" for n in (1000, 10_000) for at, place in enumerate(random.Random(42).sample(range(n), 200)))


@query(f"""with r as (select doc_id, row_number() over (order by doc_id) as place, (select count(*) from documents) as n from documents)
select doc_id, cast(pos as bigint) as sample_pos from r join (values {PICKS}) as p(n, pos, place) using (n, place)""")
def q44_seeded_sample(spark, sf_dir):
    """The sample that a seeded generator takes of the documents in the order of their ids; its SQL knows 1,000 and 10,000 rows."""
    return corpus.sample_seeded(spark, _read(spark, sf_dir, "documents").select("doc_id"), [F.col("doc_id")]).select("doc_id", F.col("sample_pos").cast("long").alias("sample_pos"))
