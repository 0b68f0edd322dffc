import hashlib
import random

from pyspark.sql import functions as F

from sparkloom.functions import models, tokens
from sparkloom.operators import context, corpus


def test_clean_and_top(spark):
    text = "\n".join(["  add a # x", "# c", "// c", ";c", "TEST x", "RVTEST_y", "test ok", "", "sub b", "sub c", "add d", " \t", "foo:"])
    rows = corpus.clean_lines(corpus.lines(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")))
    assert [r.line for r in rows.orderBy("line_no").collect()] == ["add a # x", "test ok", "sub b", "sub c", "add d", "foo:"]
    counts = corpus.count_by(corpus.opcodes(rows), "opcode", ["doc_id", "line_no"])
    assert [(r.opcode, r.n) for r in corpus.most_common(counts, 3).collect()] == [("add", 2), ("sub", 2), ("test", 1)]
    assert corpus.most_common(counts, 99).count() == 4


def test_split_sizes(spark):
    for n in (1, 4, 11):
        got = corpus.train_test_split(spark.range(n).withColumnRenamed("id", "k"), "k")
        assert got.filter("split = 'test'").count() == -(-n // 5)
        assert got.count() == n


def test_ranks_of_many_rows(spark):
    """Range bounds are sampled here: counts and rows must have the same ones."""
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("k"))
    got = {r.k: r.split for r in corpus.train_test_split(df.union(spark.range(3).select(F.lit(None).cast("long"))), "k").filter("k is not null").collect()}
    order = sorted(range(40_000), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    assert got == {k: "test" if place < 8001 else "train" for place, k in enumerate(order)}
    assert all(r.rank_no == r.k + 1 for r in corpus.ranked(df, [F.col("k")], 16).collect())
    picked = corpus.sample_seeded(spark, df, [F.col("k")]).orderBy("sample_pos").collect()
    assert [r.k for r in picked] == random.Random(42).sample(range(40_000), 200)


def test_samples(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    got = corpus.sample_seeded(spark, df, [F.col("k")]).orderBy("sample_pos").collect()
    assert [r.k for r in got] == random.Random(42).sample(range(300), 200)
    assert [r.k for r in corpus.sample_seeded(spark, df.limit(5), [F.col("k")]).orderBy("sample_pos").collect()] == [0, 1, 2, 3, 4]
    assert corpus.sample_by_digest(df, "k", 200).count() == 200


def test_tokens(spark):
    ids = spark.createDataFrame([(1, "a b  c", 2), (2, None, 0)], "i int, t string, p int").withColumn("ids", tokens.hash_ids(tokens.whitespace_tokens(F.col("t"))))
    r = ids.select(F.size("ids").alias("n"), F.size(tokens.pad(tokens.truncate(F.col("ids"), 2), 5)).alias("m"), tokens.mask_prompt(F.col("ids"), F.col("p")).alias("l")).collect()
    assert [(x.n, x.m) for x in r] == [(3, 5), (0, 5)]
    assert r[0].l[:2] == [-100, -100] and r[0].l[2] >= 0
    count = tokens.tokenizer_udf(lambda: lambda texts: [[len(w) for w in t.split()] for t in texts])
    assert [x[0] for x in ids.orderBy("i").select(count(F.col("t"))).collect()] == [[1, 1, 1], None]


def test_special_tokens_and_collation(spark):
    r = spark.range(1).select(tokens.special_tokens(F.lit("<a>x y<b>"), ("<a>", "<b>"), 1 << 24).alias("ids"), tokens.special_tokens(F.lit(None).cast("string"), ("<a>",), 9).alias("none")).first()
    plain = spark.range(1).select(tokens.hash_ids(tokens.whitespace_tokens(F.lit("x y")))).first()[0]
    assert r.ids == [1 << 24, *plain, (1 << 24) + 1] and r.none == []
    df = spark.createDataFrame([(0, [1, 9]), (0, [2, 3, 4]), (1, [])], "b int, ids array<int>")
    got = {tuple(r.ids): (r.input_ids, r.attention_mask, r.labels) for r in tokens.collate(df, "b", "ids", 9).collect()}
    assert got[1, 9] == ([1, 9, 9], [1, 1, 0], [1, -100, -100]) and got[()] == ([], [], []) and got[2, 3, 4][1] == [1, 1, 1]
    r = spark.range(1).select(tokens.pad_token(F.lit(None).cast("int"), F.lit(3)), tokens.pad_token(F.lit(0), F.lit(3)), tokens.id_to_token(F.array(F.lit(1), F.lit(2)), F.create_map(F.lit(1), F.lit("a")))).first()
    assert tuple(r) == (3, 0, ["a", None])


def test_models(spark):
    df = spark.createDataFrame([("p", [1, 2, 3], [-100, 2, 3]), ("q", [1], [-100])], "p string, ids array<int>, labels array<int>")
    losses = models.token_losses_udf(lambda: lambda rows: [[float(i) for i in ids] for ids in rows])
    got = df.select(models.complete_udf()(F.col("p"), F.lit(30)).alias("g"), models.mean_loss(losses(F.col("ids")), F.col("labels")).alias("loss")).collect()
    assert [(r.g, r.loss) for r in got] == [("addi t0, t0, 1", 2.5), ("addi t0, t0, 1", None)]


def test_windows_and_suggestions(spark):
    doc = [f"l{i}" for i in range(60)]
    rows = corpus.lines(spark.createDataFrame([(1, "\n".join(doc)), (2, "# quick sort\nx\n#\ny")], "doc_id long, text string"))
    got = {(r.doc_id, r.line_no): r for r in context.context_windows(rows, F.lit(1)).withColumn("kind", context.suggestion_type(F.lit("#"))).collect()}
    assert got[1, 0].prefix == "l" and got[1, 0].suffix == "\n".join(["0", *doc[1:21]])
    assert got[1, 41].prefix.split("\n")[0] == "l1" and got[1, 40].prefix.split("\n")[0] == "l0"
    assert got[1, 59].suffix == "59"
    kinds = rows.withColumn("k", context.suggestion_type(context.previous_line())).filter("doc_id = 2").orderBy("line_no").collect()
    assert [r.k for r in kinds] == ["realtime", "comment-to-code", "realtime", "realtime"]
    r = spark.range(1).select(*[context.suppressed(F.lit(x)) for x in (" # c", ".text", "addi")], context.token_budget(F.lit("comment-to-code"))).first()
    assert list(r) == [True, True, False, 150]


def test_debounce_edges(spark):
    rows = spark.sql("select * from values (1, timestamp'2026-01-01 00:00:00', 1), (1, timestamp'2026-01-01 00:00:00.4', 2), (1, timestamp'2026-01-01 00:00:02', 3), (2, timestamp'2026-01-01 00:00:00', 4), (2, timestamp'2026-01-01 00:00:00', 5) t(u, ts, r)")
    got = sorted((r.u, r.r, r.n) for r in context.debounce(rows, "u", "ts", "r", "500 milliseconds").collect())
    assert got == [(1, 2, 2), (1, 3, 1), (2, 5, 2)]
    assert sorted((r.u, r.r) for r in context.latest(rows, "u", "r").collect()) == [(1, 3), (2, 5)]
