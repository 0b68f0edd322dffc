"""Sources: text lines, JSON lines by split, JSON documents, requests, archives."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EXAMPLE


def table(spark: SparkSession, folder: str, name: str, least: int = 32 << 20) -> DataFrame:
    """A parquet table of a folder. One that is small, and in fewer files than there are cores, is dealt over all of
    them, as a row group is read by one task; others come as they are scanned."""
    df, cores = spark.read.parquet(f"{folder}/{name}.parquet"), spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * least and len(df.inputFiles()) < cores else df


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no from 0, line) of text files; \\n, \\r\\n and lone \\r end a line, as in Python.

    Files are read in blocks by many tasks. A line's number is its place in its block, and the lines of the blocks
    before: a table of one row for each block.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"))
    blocks = rows.groupBy("path", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return rows.join(blocks, ["path", "_block"]).select("path", (F.col("_at") - F.col("_first") + F.col("_before")).alias("line_no"), "line")


def json_lines(spark: SparkSession, path: str, schema: T.StructType = EXAMPLE, required: tuple[str, ...] = ("text",)) -> DataFrame:
    """Rows of JSON lines; malformed lines and missing required fields raise errors."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for name in required:
        rows = rows.withColumn(name, F.when(F.col(name).isNull(), F.raise_error(F.lit(f"a line has no {name}"))).otherwise(F.col(name)))
    return rows


def json_splits(spark: SparkSession, paths: dict[str, str], schema: T.StructType = EXAMPLE) -> DataFrame:
    """The rows of all splits, with column split."""
    out = None
    for split, path in paths.items():
        one = json_lines(spark, path, schema).withColumn("split", F.lit(split))
        out = one if out is None else out.unionByName(one)
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def line_count(spark: SparkSession, path: str, least: int = 1000) -> tuple[int | None, str]:
    """(lines, class): SAMPLE below `least`, else FULL; (None, "not found") without the file."""
    if not exists(spark, path):
        return None, "not found"
    n = spark.read.text(path).count()
    return n, "SAMPLE" if n < least else "FULL"


def json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON document that spans lines; a missing file gives no rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def request_stream(spark: SparkSession, path: str) -> DataFrame:
    """Request bodies, one in a line, as a stream of column body."""
    return spark.readStream.text(path).withColumnRenamed("value", "body")


def extract_zip(archive: str, target: str = ".") -> Path:
    """Unpacks a local archive on the driver; FileNotFoundError if it is missing."""
    if not Path(archive).exists():
        raise FileNotFoundError(archive)
    with zipfile.ZipFile(archive) as z:
        z.extractall(target)
    return Path(target)


def create_archive(folder: str, archive: str | None = None) -> tuple[Path, float]:
    """Packs a local folder, deflated; returns the archive and its size in MB, rounded to 0.1."""
    out = Path(archive or f"{folder.rstrip('/')}.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(Path(folder).rglob("*")):
            if p.is_file() and p != out:
                z.write(p, p.relative_to(folder))
    return out, round(out.stat().st_size / 1024 / 1024, 1)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
