import re

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import text as T

EDGES = ["a#c x", "x # c\r y\nz", "a \t\t b", "end \nnext", "# only", '.string "a#b"', " nbsp ", "", "  Mixed Case  ", "　wide　"]


def test_normalise_as_python(spark):
    def plain(t):
        return re.sub(r"[ \t]+", " ", re.sub(r"#.*", "", t)).strip().lower()

    rows = spark.createDataFrame(list(enumerate(EDGES)), "i int, t string").select("t", T.normalise(F.col("t")).alias("n"), T.strip(F.col("t")).alias("s")).collect()
    assert [(r.t, r.n, r.s) for r in rows] == [(t, plain(t), t.strip()) for t in EDGES]


PARSED = [
    ("<fim_prefix>a<fim_suffix>b<fim_middle>c", ("a", "b", "c")),
    ("<fim_prefix>a<fim_suffix>b<fim_middle>c<fim_middle>d", ("a", "b", "c")),
    ("<fim_prefix>a<fim_suffix>b<fim_suffix>x<fim_middle>c", ("a", "b", "c")),
    ("<fim_prefix>a<fim_prefix>z<fim_suffix>b<fim_middle>c", ("az", "b", "c")),
    ("q<fim_middle>a<fim_suffix>b<fim_middle>c", ("q<fim_middle>a", "b", "a<fim_suffix>b")),
    ("<fim_prefix>a<fim_middle>c", None),
    ("<fim_prefix>a<fim_suffix>c", None),
    ("", None),
]


def test_parse(spark):
    rows = spark.createDataFrame([(t,) for t, _ in PARSED], "t string").select("t", T.parse_fim(F.col("t")).alias("p")).collect()
    assert {r.t: (r.p.prefix, r.p.suffix, r.p.reference) if r.p.valid else None for r in rows} == dict(PARSED)
    with pytest.raises(Exception, match="markers"):
        spark.createDataFrame([("x",)], "t string").select(T.parse_fim(F.col("t"), strict=True)).collect()


def test_prompt_and_strips(spark):
    r = spark.range(1).select(
        T.fim_prompt(F.lit("p"), F.lit(None).cast("string")).alias("prompt"),
        T.after_prompt(F.lit("ask answer \n"), F.lit("ask")).alias("served"),
        T.after_prompt(F.lit(" other "), F.lit("ask")).alias("kept"),
        T.after_prefix(F.lit("  ask  answer"), F.lit("ask")).alias("shown"),
        T.preview(F.lit("abcdef  "), 7).alias("head"),
        T.cut_comment(F.lit(" add t0 # x # y")).alias("code"),
        T.first_token(F.lit("  add\tt0")).alias("opcode"),
        T.architecture_targets(F.lit("Big-GPT2-xl"), [("codegen", ["qkv"]), ("gpt2", ["attn", "fc"])], ["all"]).alias("modules"),
    ).first()
    assert r.prompt == "<fim_prefix>p<fim_suffix><fim_middle>"
    assert (r.served, r.kept, r.shown, r.head, r.code, r.opcode, r.modules) == ("answer", "other", "answer", "abcdef", "add t0", "add", ["attn", "fc"])
