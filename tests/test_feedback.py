import json
import random
import time
from collections import Counter

import pytest

from pyspark.sql import functions as F

from sparkloom import config, schemas
from sparkloom.operators import feedback, metrics, results
from sparkloom.sources import readers
from sparkloom.streaming import feedback as streams


def _details(spark, rows, kind, f):
    return [r[0] for r in spark.createDataFrame(rows, kind).select(f).collect()]


def test_generate_validation(spark):
    rows = [("", 30), ("x" * 512, 1), ("x" * 513, 1), ("x", 0), ("x", -1), (" ", 1), ("", 0), (None, 1)]
    got = _details(spark, rows, "p string, m int", feedback.generate_detail(F.col("p"), F.col("m")))
    assert got == ["Prefix is required", None, "Prefix exceeds 512 characters", "max_new_tokens must be greater than 0", "max_new_tokens must be greater than 0", None, "Prefix is required", "Prefix is required"]


def test_rating_validation(spark):
    rows = [("s", 1, "realtime"), ("s", 0, "comment-to-code"), ("s", None, "realtime"), ("s", 3, "unknown"), ("", 3, "realtime"), ("s", 1, "unknown")]
    got = _details(spark, rows, "s string, r int, k string", feedback.rating_detail(F.col("s"), F.col("r"), F.col("k")))
    assert [x and x.split()[0] for x in got] == [None, None, None, "Rating", "Suggestion", "suggestion_type"]


def test_requests(spark):
    rows = [('{"prefix":"p","suggestion":"s"}',), ('{"suggestion":"s"}',), ("broken",), ('{"prefix":"","suggestion":"s","accepted":false}',)]
    record, status = feedback.parse_requests(F.col("b"), schemas.RATING_REQUEST, schemas.RATING_DEFAULTS, schemas.RATING_REQUIRED)
    got = spark.createDataFrame(rows, "b string").select(record.alias("r"), status.alias("s")).collect()
    assert [r.s for r in got] == [200, 422, 422, 200]
    assert (got[0].r.suffix, got[0].r.suggestion_type, got[0].r.accepted, got[0].r.rating) == ("", "realtime", True, None)
    assert got[3].r.accepted is False


def test_table(spark):
    spark.sql("drop table if exists old_rating")
    spark.sql("create table old_rating (id long, prefix string, suggestion string, rating int) using parquet")
    spark.sql("insert into old_rating values (7, 'p', 's', 1)")
    for _ in range(2):
        feedback.init_table(spark, "old_rating")
    assert [c.name for c in spark.catalog.listColumns("old_rating")][4:] == ["suffix", "suggestion_type", "accepted", "timestamp", "request_key"]
    new = spark.createDataFrame([("p", "x", "s", None, "realtime", False, "2026-01-01T00:00:00.123Z"), ("p", "x", "s", 1, "realtime", True, "")], "prefix string, suffix string, suggestion string, rating int, suggestion_type string, accepted boolean, timestamp string")
    spark.sql("drop table if exists fresh_rating")
    feedback.init_table(spark, "fresh_rating")
    feedback.save(spark, new, "fresh_rating")
    feedback.save(spark, new, "fresh_rating")
    assert sorted(r.id for r in spark.table("fresh_rating").collect()) == [1, 2, 3, 4]
    got = feedback.find_all(spark, "fresh_rating").collect()
    assert all(r.timestamp for r in got) and {r.accepted for r in got} == {True, False}
    assert feedback.find_all(spark, "old_rating").first().suggestion_type == "realtime"


def test_large_batches_get_consecutive_ids(spark):
    spark.sql("drop table if exists large_rating")
    feedback.init_table(spark, "large_rating")
    n = 120_000
    place = (F.col("id") * 7919) % n  # the order of ts
    rows = spark.range(n).select(place.cast("string").alias("prefix"), F.lit("x").alias("suffix"), F.lit("s").alias("suggestion"), F.lit(1).alias("rating"), F.lit("realtime").alias("suggestion_type"), F.lit(True).alias("accepted"), F.date_format(F.timestamp_seconds(place + 1_700_000_000), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"))
    for done in (0, n):
        feedback.save(spark, rows, "large_rating")
        got = spark.table("large_rating").filter(F.col("id") > done)
        assert got.count() == n and got.filter(F.col("id") - done - 1 != F.col("prefix").cast("long")).isEmpty()


def test_request_types(spark):
    head = '{"prefix":"p","suggestion":"s",'
    bad = ['"rating":"x"}', '"rating":1.5}', '"rating":[1]}', '"accepted":"maybe"}', '"accepted":2}', '"suffix":null}', '"suffix":5}', '"accepted":null}']
    good = ['"rating":null}', '"rating":"1"}', '"rating":1.0}', '"accepted":"no"}', '"accepted":0}', '"other":[1]}', '"rating":99999999999}']
    record, status = feedback.parse_requests(F.col("b"), schemas.RATING_REQUEST, schemas.RATING_DEFAULTS, schemas.RATING_REQUIRED)
    rows = spark.createDataFrame([(i, head + t) for i, t in enumerate(bad + good)] + [(90, "[]"), (91, "5"), (92, None), (93, "{")], "i int, b string")
    got = rows.select("i", record.alias("r"), status.alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [422] * len(bad) + [200] * len(good) + [422] * 4
    assert [(r.r.rating, r.r.accepted) for r in got if r.s == 200] == [(None, True), (1, True), (1, True), (None, False), (None, False), (None, True), (2147483647, True)]
    r = spark.range(1).select(feedback.response(F.lit(200), F.lit(None).cast("string"), feedback.generated(F.lit("nop"))).alias("a"), feedback.response(F.lit(400), F.lit("no"), feedback.saved()).alias("b")).first()
    assert (r.a, r.b) == ('{"generated_code":"nop"}', '{"detail":"no"}')


def test_save_refuses_what_the_table_may_not_hold(spark):
    spark.sql("drop table if exists strict_rating")
    feedback.init_table(spark, "strict_rating")
    bad = spark.createDataFrame([("p", "x", "s", 3, "realtime", True, "")], "prefix string, suffix string, suggestion string, rating int, suggestion_type string, accepted boolean, timestamp string")
    with pytest.raises(Exception, match="Rating must be 0 or 1"):
        feedback.save(spark, bad, "strict_rating")
    assert feedback.find_all(spark, "strict_rating").count() == 0


def test_drain(spark):
    for name in ("drained", "drained_queue"):
        spark.sql(f"drop table if exists {name}")
    feedback.init_table(spark, "drained")
    feedback.init_queue(spark, "drained_queue")
    assert feedback.drain(spark, "drained_queue", "drained") == {}
    kind = "request_key string, prefix string, suffix string, suggestion string, rating int, suggestion_type string, accepted boolean, timestamp string"
    row = lambda k, s="s", r=1: (k, "p", "", s, r, "realtime", True, "2026-01-01T00:00:00Z")
    rows = spark.createDataFrame([row("a"), row("a"), row("b", ""), row("c"), row(None), row(None)], kind)
    feedback.enqueue(spark, rows, "drained_queue")
    assert feedback.drain(spark, "drained_queue", "drained") == {"delivered": 4, "duplicate": 1, "parked": 1}
    feedback.enqueue(spark, rows.filter("request_key in ('a', 'c')"), "drained_queue")
    assert feedback.drain(spark, "drained_queue", "drained") == {"duplicate": 3, "parked": 1}
    assert [r.request_key for r in spark.table("drained_queue").collect()] == ["b"]
    assert sorted(str(r.request_key) for r in spark.table("drained").collect()) == ["None", "None", "a", "c"]


def test_stream_batches_are_stored_once(spark, tmp_path):
    """A batch that is repeated, as after a failure before its commit, stores nothing twice."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text('{"prefix":"p","suggestion":"s"}\n{"prefix":"p","suggestion":"t","rating":"x"}')
    spark.sql("drop table if exists once_rating")
    feedback.init_table(spark, "once_rating")

    def run():
        streams.ingest(spark, readers.request_stream(spark, str(tmp_path / "in")), "once_rating", str(tmp_path / "dead"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)

    run()
    for f in (tmp_path / "cp/commits").glob("*0*"):
        f.unlink()
    run()
    assert feedback.find_all(spark, "once_rating").count() == 1
    assert spark.read.json(str(tmp_path / "dead")).count() == 1


def test_stale_answers_are_dropped(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    kind = "key string, request long, answer string"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(kind).json(str(tmp_path / "in"))
    try:
        for n, lines in enumerate((
            ['{"key":"a","request":1}', '{"key":"b","request":7}'],
            ['{"key":"a","request":2}', '{"key":"a","request":1,"answer":"old"}', '{"key":"b","request":7,"answer":"  "}'],
            ['{"key":"a","request":2,"answer":"new"}', '{"key":"b","request":6,"answer":"late"}'],
        )):
            (tmp_path / f"in/{n}.json").write_text("\n".join(lines))
            streams.without_stale(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
        assert [tuple(r) for r in spark.read.schema(kind).parquet(str(tmp_path / "out")).collect()] == [("a", 2, "new")]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_queue(spark):
    rows = spark.createDataFrame([(1, "", 1, "realtime"), (2, "s", 1, "realtime"), (3, "s", None, "realtime")], "k int, suggestion string, rating int, suggestion_type string")
    got = feedback.flush(rows.union(rows.filter("k = 2")), spark.createDataFrame([(3,), (3,)], "k int"), "k").collect()
    assert sorted((r.k, r.state) for r in got) == [(1, "parked"), (2, "delivered"), (2, "duplicate"), (3, "duplicate")]


def test_queue_whose_rows_come_in_another_order_each_time(spark):
    def mixed(batches):
        for b in batches:
            at = list(range(b.num_rows))
            random.SystemRandom().shuffle(at)
            yield b.take(at)

    key = F.when(F.col("id") % 9 == 0, None).when(F.col("id") % 9 == 1, -1).otherwise(F.col("id") % 5000)
    rows = spark.range(0, 9000, 1, 6).select(key.alias("k"), F.when(F.col("id") % 4 == 0, "").otherwise("s").alias("suggestion"), F.lit(1).alias("rating"), F.lit("realtime").alias("suggestion_type"))
    want, seen = Counter(), {2}
    for r in rows.collect():
        state = "parked" if not r.suggestion else "duplicate" if r.k in seen else "delivered"
        want[r.k, state] += 1
        if state == "delivered" and r.k is not None:
            seen.add(r.k)
    got = feedback.flush(rows.mapInArrow(mixed, rows.schema), spark.createDataFrame([(2,), (None,)], "k long"), "k").collect()
    assert Counter((r.k, r.state) for r in got) == want


def test_stream_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    bodies = [{"prefix": "p", "suggestion": "s", "rating": 1}, {"prefix": "p", "suggestion": ""}, {"prefix": "p"}]
    (tmp_path / "in/a.txt").write_text("\n".join(map(json.dumps, bodies)))
    spark.sql("drop table if exists live_rating")
    feedback.init_table(spark, "live_rating")
    streams.ingest(spark, readers.request_stream(spark, str(tmp_path / "in")), "live_rating", str(tmp_path / "dead"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert feedback.find_all(spark, "live_rating").count() == 1
    dead = spark.read.json(str(tmp_path / "dead")).collect()
    assert sorted(r.status for r in dead) == [400, 422]


def test_stream_bursts(spark, tmp_path):
    rows = spark.sql("select * from values ('a', timestamp'2026-01-01 00:00:00', 1), ('a', timestamp'2026-01-01 00:00:00.4', 2), ('a', timestamp'2026-01-01 00:10:00', 3) t(u, ts, r)")
    rows.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = streams.bursts(stream, "u", "ts", "r", "500 milliseconds", "1 second").writeStream.format("memory").queryName("bursts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.r, r.n) for r in spark.table("bursts").collect()] == [(2, 2)]


def test_bleu(spark):
    pairs = spark.createDataFrame([(1, "the cat sat on the mat", "the cat sat on the mat"), (2, "a b c d e", "a b x d e f")], "k int, reference string, generated string")
    got = metrics.bleu(metrics.bleu_counts(pairs, "k")).first()
    # By hand: 10 of 12, 7 of 10, 4 of 8, 3 of 6 n-grams match; hypotheses are longer than references.
    assert abs(got.bleu - 100 * (10 / 12 * 7 / 10 * 4 / 8 * 3 / 6) ** 0.25) < 1e-9
    assert metrics.bleu(metrics.bleu_counts(pairs.limit(0), "k")).first().bleu == 0
    t = spark.range(1).select(metrics.tokens_13a(F.lit('Say &quot;1,000.5-2&quot;, x-y.\nok'))).first()[0]
    assert t == ["Say", '"', "1,000.5", "-", "2", '"', ",", "x-y", ".", "ok"]


def test_matches_and_perplexity(spark):
    pairs = spark.createDataFrame([(1, "", "x"), (2, "Add # c", "add"), (3, "a", "ab"), (4, "a", "b")], "k int, reference string, generated string")
    assert tuple(metrics.match_report(pairs).first()) == (4, 25.0, 75.0)
    assert tuple(metrics.match_report(pairs.limit(0)).first()) == (0, None, None)
    rows = spark.createDataFrame([(0.0, 1), (800.0, 1), (None, 1), (1.0, 0), (1.0, -1)], "loss double, ref_len int")
    assert tuple(metrics.perplexity_report(rows).first()) == (1.0, 1, 4)


def test_results(spark, tmp_path):
    old, new = spark.createDataFrame([("A", 1), ("B", 2)], "v string, x int"), spark.createDataFrame([("B", 3), ("C", 4)], "v string, x int")
    both = results.upsert(old, new, "v")
    assert sorted(tuple(r) for r in both.collect()) == [("A", 1), ("B", 3), ("C", 4)]
    assert [r.x for r in results.pick(both, "v", ["C", "A"]).orderBy("place").collect()] == [4, 1]
    assert readers.json_document(spark, str(tmp_path / "none.json"), schemas.RUN_RESULT).count() == 0
    (tmp_path / "t.txt").write_bytes(b"a\r\nb\rc\n\nd")
    assert [r.line for r in readers.text_lines(spark, str(tmp_path / "t.txt")).orderBy("line_no").collect()] == ["a", "b", "c", "", "d"]
    (tmp_path / "many").mkdir()
    lines = {k: [f"{k} {i}" * (i % 7) for i in range(3000)] for k in "ab"}
    for k, x in lines.items():
        (tmp_path / f"many/{k}.txt").write_text("\n".join(x) + "\n")
    (tmp_path / "many/none.txt").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        many = readers.text_lines(spark, str(tmp_path / "many"))
        for k, x in lines.items():
            assert [(r.line_no, r.line) for r in many.filter(F.col("path").endswith(f"{k}.txt")).orderBy("line_no").collect()] == list(enumerate(x))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert readers.line_count(spark, str(tmp_path / "t.txt"))[1] == "SAMPLE" and readers.line_count(spark, str(tmp_path / "no"))[1] == "not found"
    (tmp_path / "j.json").write_text('{"text": "a"}\n{"other": 1}\n')
    try:
        readers.json_splits(spark, {"train": str(tmp_path / "j.json")}).collect()
        raise AssertionError("a missing field must fail")
    except Exception as e:
        assert "no text" in str(e)
    readers.write_json(both, str(tmp_path / "rows"))
    assert sorted(tuple(r) for r in spark.read.schema("v string, x int").json(str(tmp_path / "rows")).collect()) == [("A", 1), ("B", 3), ("C", 4)]
    assert readers.line_count(spark, str(tmp_path / "j.json"))[0] == 2
    with pytest.raises(Exception, match="no result"):
        results.pick(both, "v", ["C", "Z"]).collect()
    plan = results.pick(both, "v", ["C"])._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan.rpartition("Physical Plan")[2]
    assert [r[0] for r in spark.sql("select 1.23456D as x union all select null").select(results.report_line("loss", F.col("x"))).collect()] == ["loss: 1.2346", "loss: none"]
    made, mb = readers.create_archive(str(tmp_path), str(tmp_path / "z.zip"))
    assert made.exists() and readers.extract_zip(str(made), str(tmp_path / "out")).exists()
    assert spark.range(1).select(*results.health("v1", "b", "a")).first().status == "running"
    got = config.load("MAX_INPUT_LENGTH=9\nother=1\n# x=y\nFIM_MIDDLE='<m>'\n")
    assert (got.max_input_length, got.markers) == (9, ("<fim_prefix>", "<fim_suffix>", "<m>"))


def test_small_tables_are_dealt_over_all_cores(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    got = readers.table(spark, str(tmp_path), "one")
    assert got.select(F.spark_partition_id()).distinct().count() == spark.sparkContext.defaultParallelism and got.count() == 100
    assert readers.table(spark, str(tmp_path), "one", least=0).select(F.spark_partition_id()).distinct().count() == 1


def test_debounce_stream(spark, tmp_path):
    """Each key's last request comes out once after silence; needs the state store that keeps timers."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "key string, request long, payload string")
    rows.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = streams.debounced(stream).writeStream.format("memory").queryName("fired").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        until = time.time() + 90
        while time.time() < until and spark.table("fired").count() < 2:
            time.sleep(1)
        assert sorted((r.key, r.request, r.payload) for r in spark.table("fired").collect()) == [("a", 2, "y"), ("b", 3, "z")]
    finally:
        q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
