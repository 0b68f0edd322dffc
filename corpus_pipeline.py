"""A corpus pipeline of five stages; each works on what the one before kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontam, langid, mixing, neardup, tokens
from sparkloom.llm.common import discard, fold, hot_join, mark, materialise

#: Documents below this share of the best language are rejected, as are texts without letters.
LEAST_SCORE = 0.5
#: Rows to drop that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Columns that stages add and take away; no column of the documents has these names.
ROW, COPIES, COPY, FOUND = "__sparkloom_row", "__sparkloom_copies", "__sparkloom_copy", "__sparkloom_found"


def _numbered(docs: DataFrame) -> DataFrame:
    """docs, read from files, with a key of each row: its text's hash, its file and its place there, which are the same
    whatever the scan is split into. Keys of rows with different texts have the same order in every run."""
    return docs.withColumn(ROW, F.concat_ws("/", F.hex(F.xxhash64("text")), F.hex(F.xxhash64("_metadata.file_path")), "_metadata.row_index"))


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    few = dropped.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(dropped) if few else dropped, ROW, "left_anti").drop(ROW)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; the model learns from four fifths of the documents.

    Null texts and texts without letters go, whatever their lang; repeated rows are judged alike; without labelled
    documents every row goes, as no language is known; an empty table gives an empty one.
    """
    model = langid.fit(spark, docs.filter(fold("doc_id", 5) != 0))
    found = docs.withColumn(FOUND, langid.detector(spark, model)(F.col("text")))
    return found.filter((F.col(FOUND)["lang_pred"] != "und") & (F.col(FOUND)["score"] >= LEAST_SCORE)).drop(FOUND)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of near duplicates: five-word shingles, similarity 0.8.

    Null texts and texts without words are duplicates of nothing and stay; of rows with the same id
    that of the smaller hash of its text stays; a null id is larger than all others; an empty table gives an empty one.
    """
    rows, start = _numbered(docs), mark()
    found = neardup.near_dedup(spark, rows, 5, 80, keep=(ROW,)).filter("component is not null").select("component", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW).alias("_at"))
    found = materialise(spark, found, "groups")
    first = found.groupBy("component").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    first = materialise(spark, first, "first")
    dropped = hot_join(found, first, "component", "_n", found.count()).filter("_at <> _first").select(F.col("_at")[ROW].alias(ROW))
    dropped = materialise(spark, dropped, "dropped")
    discard(spark, start, mark() - 1)
    return _without(rows, dropped)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with any window of a benchmark item.

    Null texts have no window and stay, as do all rows without a benchmark; repeated rows are judged alike; an
    empty table gives an empty one.
    """
    rows = _numbered(docs)
    found = decontam.decontaminate(spark, rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=(ROW,))
    return _without(rows, materialise(spark, found.filter("n_hit > 0").select(ROW), "dropped"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources come near their target weights.

    Null texts and texts without words add nothing to a mix and go; a null source is a source of its own; repeated
    rows are rounded one by one; an empty table gives an empty one.
    """
    rows, start = _numbered(docs), mark()
    taken = mixing.mix(spark, rows, row_col=ROW).filter("copies <> 1").select(ROW, F.col("copies").alias(COPIES))
    taken = materialise(spark, taken, "copies")
    discard(spark, start, mark() - 1)
    few = taken.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(taken) if few else taken, ROW, "left")
    times = F.coalesce(F.col(COPIES), F.lit(1)).cast("int")
    return joined.filter(times > 0).withColumn(COPY, F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token sequences in training order; returns the records as read back from the shards."""
    return tokens.token_output(spark, docs)


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_shards),
]

#: SQL cannot fit models, round dependently or write shards; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written to the shared folder and read again.

    What a stage wrote on its way, and the result of the stage before, is deleted once its own result is there.
    """
    docs, start = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark()
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(spark, start, mark() - 1)
    return STAGES[-1][1](spark, docs, sf_dir)
