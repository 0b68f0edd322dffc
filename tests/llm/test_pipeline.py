"""Stages of the pipeline, each against a plain version."""

from collections import Counter

import corpus_pipeline as p
from sparkloom.llm import common, tokens

from .test_ops import BASE, ITEM, near, say


def test_stages(spark, tmp_path):
    clean = [say(40) for _ in range(30)]
    texts = clean + [BASE, near(BASE, 1), BASE, "before " + ITEM + " after", "... 12", None]
    rows = [(i, t, "xx", f"s{i % 2}", 0, "clash", 1) for i, t in enumerate(texts)] + [(30, BASE, "xx", "s0", 0, "clash", 1)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, copies int"
    home = str(tmp_path)
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{home}/documents.parquet"), []
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, home)
        assert out.columns == docs.columns
        docs = common.materialise(spark, out, "stage")
        kept.append(Counter(r.doc_id for r in docs.collect()))
    assert set(kept[0]) == set(range(34))
    assert kept[1] == Counter([*range(31), 33])
    assert set(kept[2]) == set(range(31))
    assert set(kept[3].values()) <= {1, 2} and set(kept[3]) <= set(range(31))
    last = p.STAGES[-1][1](spark, docs, home)
    assert Counter(r.doc_id for r in last.filter("part = 0").collect()) == kept[3]
    assert p.run(spark, home).count() == last.count()
    empty = docs.limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, common.materialise(spark, empty, "none"), home).count() == 0


def test_last_stage_is_readable(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some text here")], "doc_id long, text string")
    tokens.write_shards(spark, docs, str(tmp_path / "x"))
    got = tokens.read_shards(spark, str(tmp_path / "x"), with_tokens=True).first()
    assert tokens.decode(got.tokens) == "some text here"
