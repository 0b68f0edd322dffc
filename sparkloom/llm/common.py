"""What several operators share: the shared folder, fold numbers, joins with hot keys, components."""

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL: list[str] = []
_WRITTEN: list[str] = []

#: At most this many keys can each hold 1/HOT_KEYS of all rows, so that a table of them may be broadcast.
HOT_KEYS = 1000
#: Bytes of an Arrow batch on its way to a Python worker; a single longer row is a batch of its own.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it.

    A session that names none gets a temporary folder if it runs in one process, as in tests; on a cluster each
    executor would write to its own disk, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append("file://" + tempfile.mkdtemp(prefix="sparkloom-"))
    return _LOCAL[0]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/sparkloom/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by BATCH_BYTES for what the session runs from here on: 10,000 long texts are no batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def mark() -> int:
    """How many scratch paths there are; what is written from here on can be discarded."""
    return len(_WRITTEN)


def discard(spark: SparkSession, since: int, until: int | None = None) -> None:
    """Deletes the scratch paths written since a mark, whose results have been written or consumed elsewhere."""
    for path in _WRITTEN[since:until]:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    del _WRITTEN[since:until]


@contextlib.contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Scans of the same files have the same partitions within, however many executors there are from time to time."""
    name = "spark.sql.files.minPartitionNum"
    given = spark.conf.get(name, None)
    spark.conf.set(name, given or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, given) if given else spark.conf.unset(name)


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage ends here and lost executors lose nothing."""
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_number(docs: DataFrame, column: str) -> Column:
    """An integer id as a long; ids of other types are an error."""
    if not isinstance(docs.schema[column].dataType, T.IntegralType):
        raise ValueError(f"{column} must be an integer, not {docs.schema[column].dataType.simpleString()}")
    return F.col(column).cast("long")


def key_text(column: str) -> Column:
    """A key as text; null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """crc32 of the key's text modulo folds; a null key has crc32 0."""
    return F.crc32(key_text(column).cast("binary")) % folds


def longs(spark: SparkSession, rows: list[tuple[int, ...]], *names: str) -> DataFrame:
    """A small table of integers as part of the plan: no Python worker makes it. There is at least one row."""
    values = ", ".join("(" + ", ".join(f"{x}L" for x in row) + ")" for row in rows)
    return spark.sql(f"select * from values {values} as t({', '.join(names)})")


def hash_bound(wanted: int, rows: int) -> int:
    """The largest of 63-bit hashes with which about so many of the rows are chosen."""
    return ((1 << 63) - 1) * min(wanted, rows) // rows


def hot_join(big: DataFrame, small: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """big left join small on key (small has each key once), where small.rows counts the key's rows in big.

    Keys with 1/HOT_KEYS of all rows or more are at most HOT_KEYS: those are broadcast, and the others,
    none of which is large, are joined by a shuffle.
    """
    limit = max(1, total // HOT_KEYS)
    hot, cold = small.filter(F.col(rows) >= limit), small.filter(F.col(rows) < limit)
    marked = big.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    rest = marked.filter(F.col("_hot").isNull()).select(*big.columns).join(cold, key, "left")
    return marked.filter(F.col("_hot")).select(*rest.columns).unionByName(rest)


def numbered(spark: SparkSession, df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df in a total order, range partitioned, with _pid and _at: its partition and its place there (from 0)."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    out = materialise(spark, ranged, name)
    return out.select(*df.columns, F.shiftright("_mid", 33).alias("_pid"), F.col("_mid").bitwiseAND((1 << 33) - 1).alias("_at"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of edges (a, b): label is the smallest node that can be reached.

    Each round takes the smallest label among neighbours, then the label of that label; every round is
    written to the shared folder, and rounds end when no label has changed; the labels of the round before are
    deleted then. A large component has one label and a hub many neighbours: these are inner joins of narrow rows
    with a table of unique keys, whose skewed partitions adaptive execution splits.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct()
    edges_at = mark()
    both = materialise(spark, both, "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = materialise(spark, labels, "labels")
    before = mark() - 1
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        new = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        new = new.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label"))
        new = materialise(spark, new, "labels")
        labels, ended = new.select("node", "label"), new.filter("label < old").isEmpty()
        discard(spark, before, before + 1)
        if ended:
            discard(spark, edges_at, edges_at + 1)
            return labels
        before = mark() - 1


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of few rows, so that what is made of a batch stays small; memory is given back at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Returns what is free to the system: workers are kept for the tasks of later stages.

    Arrow's pool and the C library's heap (where it is glibc's) hold on to freed memory otherwise.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
