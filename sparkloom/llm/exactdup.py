"""Exact dedup by content sort: sampled splitters, external sort, comparison of neighbours."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_KEYS

#: Runs of white space other than one lone space; replacing them by a space leaves every run one space.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 32, salts: int = 64) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    Spark samples splitters of (first characters, hash) of the normalised text, so that equal texts share a
    range; each range is sorted externally by the whole text and id, and a window over the sorted rows compares
    each text with its neighbour's in full. The row with the smallest id of each run stays.

    A text that holds 1/1000 of all rows or more (at most 1000 texts do) is counted first, before any text is
    shuffled; its rows are dealt over ranges by a salt and take the smallest id and the count from that table.

    Null texts equal the empty text. Null ids are larger than all others; of rows with equal text and id one
    stays. Columns beyond id and text are not read, whatever their names. An empty table gives an empty one.
    """
    base = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm"))
    base = base.withColumn("_sha", F.sha2(F.col("_norm").cast("binary"), 256))
    limit = max(2, docs.count() // HOT_KEYS)
    hot = base.groupBy("_sha").agg(F.count("*").alias("_hot_n"), F.min("_id").alias("_hot_id")).filter(F.col("_hot_n") >= max(limit, 100))
    rows = base.join(F.broadcast(hot), "_sha", "left")
    rows = rows.select(
        "*",
        F.substring("_norm", 1, prefix).alias("_pre"),
        F.xxhash64("_norm").alias("_h"),
        F.when(F.col("_hot_n").isNull(), 0).otherwise(F.pmod(F.xxhash64("_id"), F.lit(salts))).alias("_salt"),
    )
    ranged = rows.repartitionByRange("_pre", "_h", "_salt")
    run = Window.partitionBy("_pre", "_h", "_salt", "_norm")
    out = ranged.select(
        F.col("_id"),
        F.coalesce("_hot_id", F.min("_id").over(run)).alias("keep_id"),
        F.coalesce("_hot_n", F.count("*").over(run)).alias("group_size"),
        F.row_number().over(run.orderBy(F.col("_id").asc_nulls_last())).alias("_nth"),
        F.col("_sha").alias("text_sha256"),
    )
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size", ((F.col("_nth") == 1) & F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")
