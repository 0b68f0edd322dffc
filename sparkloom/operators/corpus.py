"""Corpus cleaning, frequencies, split and sample."""

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cut_comment, first_token, starts_with_any, strip

#: Beginnings of lines that are no code.
NOT_CODE = ("#", "//", ";", "TEST", "RVTEST")


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no from 0, line) of each text; null texts have no lines."""
    return docs.select(id_col, F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "line"))


def clean_lines(rows: DataFrame, line: str = "line") -> DataFrame:
    """Stripped lines that are neither empty nor begin as comments or test macros; other columns stay."""
    return rows.withColumn(line, strip(F.col(line))).filter((F.col(line) != "") & ~starts_with_any(F.col(line), NOT_CODE))


def opcodes(rows: DataFrame, line: str = "line") -> DataFrame:
    """The first token of each line before its comment; lines that are empty then are dropped."""
    return rows.withColumn("_code", cut_comment(F.col(line))).filter("_code <> ''").withColumn("opcode", first_token(F.col("_code"))).drop("_code")


def count_by(rows: DataFrame, key: str, place: list[str]) -> DataFrame:
    """(key, n, first_seen): counts, and the least place, which breaks ties. One shuffle of partial counts."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("first_seen"))


def most_common(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent keys, first seen first among equals; each task keeps k rows only."""
    return counts.orderBy(F.desc("n"), "first_seen").limit(k)


def size_class(n: Column, least: int = 1000) -> Column:
    return F.when(n < least, "SAMPLE").otherwise("FULL")


def _once(df: DataFrame) -> DataFrame:
    """df as rows of one RDD, whose shuffles and sampled range bounds are those of every reading."""
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.toJavaRDD(), df._jdf.schema()), spark)


def ranked(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """df with rank_no, its place (from 1) in a total order, without a single task for all rows.

    Rows are range partitioned and numbered there; the partitions' counts, one row each, give the offsets. Counts
    and rows are read of the same RDD, as another plan would sample other bounds.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = _once(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright("_mid", 33)
    offsets, before = [], 0
    for p, c in sorted(tuple(r) for r in placed.groupBy(pid.alias("p")).count().collect()):
        offsets.append((p, before))
        before += c
    at = spark.createDataFrame(offsets, "_pid long, _before long")
    out = placed.withColumn("_pid", pid).join(F.broadcast(at), "_pid")
    return out.withColumn("rank_no", F.col("_mid").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1).drop("_mid", "_pid", "_before")


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2, seed: str = "") -> DataFrame:
    """Adds split: exactly ceil(test_size * n) rows are `test`, by md5 of seed and key, so that reruns agree. Null keys come last."""
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    n = df.count()
    tests = -int(-(n * test_size) // 1)
    order = [F.col("_digest").asc_nulls_last(), F.col(key).asc_nulls_last()]
    return ranked(df.withColumn("_digest", digest), order).withColumn("split", F.when(F.col("rank_no") <= tests, "test").otherwise("train")).drop("_digest", "rank_no")


def sample_by_digest(df: DataFrame, key: str, k: int = 200) -> DataFrame:
    """k rows by md5 of the key, with sample_pos from 1; all rows if there are no more than k."""
    from pyspark.sql import Window

    few = df.withColumn("_digest", F.md5(F.col(key).cast("string"))).orderBy("_digest", key).limit(k)
    return few.withColumn("sample_pos", F.row_number().over(Window.orderBy("_digest", key))).drop("_digest")


def sample_seeded(spark: SparkSession, df: DataFrame, order: list[Column], k: int = 200, seed: int = 42) -> DataFrame:
    """The rows that Python's random.Random(seed).sample takes of the ordered rows, with sample_pos.

    If there are no more than k rows, all of them in order. Only k numbers are broadcast.
    """
    n = df.count()
    picks = random.Random(seed).sample(range(n), k) if k and k < n else range(n)
    rows = ranked(df, order)
    if k is None or k >= n:
        return rows.withColumnRenamed("rank_no", "sample_pos")
    chosen = spark.createDataFrame([(i + 1, p + 1) for p, i in enumerate(picks)], "rank_no long, sample_pos long")
    return rows.join(F.broadcast(chosen), "rank_no").drop("rank_no")
