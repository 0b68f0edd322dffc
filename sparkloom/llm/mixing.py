"""Mixing sources to target weights by pivotal dependent rounding of copies."""

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_join, longs, materialise, numbered, small_batches, whole_number

WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1
#: Rows of all sources that one bucket of the first level holds, and residuals that one task of the next combines.
BUCKET, FAN_IN = 20_000, 64
FIELDS = pa.schema([("_id", pa.int64()), ("_row", pa.string()), ("size", pa.int64()), ("_rank", pa.int64()), ("_bucket", pa.int64()), ("_f", pa.float64()), ("_h", pa.int64()), ("_open", pa.bool_())])


def _uniform(*parts: int) -> float:
    """A number in [0, 1) from integers, the same in every run."""
    x = 0x9E3779B97F4A7C15
    for p in parts:
        x = ((x ^ (p & MASK)) * 0xBF58476D1CE4E5B9) & MASK
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
        x ^= x >> 31
    return (x >> 11) / (1 << 53)


def pivot(size_a: int, a: float, size_b: int, b: float, u: float) -> tuple[float, float]:
    """Moves words between two documents until one probability is 0 or 1.

    size_a * a + size_b * b stays as it is, and so does the expectation of either probability.
    """
    to_a, to_b = min((1 - a) * size_a, b * size_b), min(a * size_a, (1 - b) * size_b)
    moved = to_a if u * (to_a + to_b) < to_b else -to_b
    a, b = a + moved / size_a, b - moved / size_b
    snap = lambda x: 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
    return snap(a), snap(b)


def settle(batches: Iterable[pa.RecordBatch], seed: int = 0) -> Iterator[pa.RecordBatch]:
    """Rounds each (rank, bucket) run of sorted rows; at most one row of a run stays open.

    Rows come with the largest documents first, so the one that stays open tends to be small.
    """
    names = FIELDS.names
    carry: dict | None = None
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if row["size"] == 0 or row["_f"] in (0.0, 1.0):
                out.append(row | {"_f": 0.0 if row["size"] == 0 else row["_f"], "_open": False})
                continue
            if carry is None or (carry["_rank"], carry["_bucket"]) != (row["_rank"], row["_bucket"]):
                if carry is not None:
                    out.append(carry)
                carry = row | {"_open": True}
                continue
            carry["_f"], row["_f"] = pivot(carry["size"], carry["_f"], row["size"], row["_f"], _uniform(seed, carry["_h"], row["_h"]))
            pair = [carry, row | {"_open": True}]
            done = [x | {"_open": False} for x in pair if x["_f"] in (0.0, 1.0)]
            carry = next((x for x in pair if x["_f"] not in (0.0, 1.0)), None)
            out += done
        if out:
            yield pa.RecordBatch.from_pydict({n: [r[n] for r in out] for n in names}, schema=FIELDS)
    if carry is not None:
        yield pa.RecordBatch.from_pydict({n: [carry[n]] for n in names}, schema=FIELDS)


def source_targets(spark: SparkSession, sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds _rank and target to (source, source_size, ...): shares by weight, at most so many times the size.

    Sources are ranked by code point, null last. What is above a source's limit is shared again by weight among
    the others until none is above; each round is one aggregation of the table of sources.
    """
    ranked = numbered(spark, sources, [F.col("source").asc_nulls_last()], "sources")
    before, offsets = 0, []
    for pid, n in sorted(tuple(r) for r in ranked.groupBy("_pid").count().collect()):
        offsets.append((pid, before))
        before += n
    at = longs(spark, offsets or [(0, 0)], "_pid", "_before")
    ranked = ranked.join(F.broadcast(at), "_pid").withColumn("_rank", F.col("_at") + F.col("_before"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight).withColumn("_most", F.col("source_size") * F.lit(float(most)))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * min(share, most)
    rate, capped = 0.0, -1
    while True:
        full = F.col("_most") <= F.col("_w") * rate
        n, used, free = ranked.agg(F.count_if(full), F.sum(F.when(full, F.col("_most"))), F.sum(F.when(~full, F.col("_w")))).first()
        if n == capped or not free:
            break
        rate, capped = (total - (used or 0.0)) / free, n
    target = F.least(F.col("_most"), F.col("_w") * rate) if free else F.col("_most")
    return ranked.select(*sources.columns, "_rank", target.alias("target"))


def mix(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, row_col: str | None = None) -> DataFrame:
    """One row for each row of docs: id, size, source, source_size, target, copies, taken (and row_col if given).

    Size is the number of words. A source's documents are to be taken target / source_size times each: the whole
    part is certain, the rest is rounded. Buckets of at most about 20,000 rows round their rows source by source,
    leaving one open document each; 64 buckets' open documents meet in each task of the next level, until every
    source has one left, which goes to the nearer side. So a source misses its target by less than that document.

    Buckets and chances depend on ids, texts and the seed only: reruns agree, also after executors are lost. Null
    texts and texts without words have size 0 and take no part; a null source is a source of its own; repeated
    rows are rounded separately; an empty table gives an empty one; other columns are not read. Ids are integers or
    null; those of another type raise ValueError.
    """
    small_batches(spark)
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    row = F.lit(None).cast("string") if row_col is None else F.col(row_col).cast("string")
    base = materialise(spark, docs.select(whole_number(docs, id_col).alias("_id"), row.alias("_row"), F.col(source_col).cast("string").alias("source"), size.alias("size"), F.xxhash64(text_col).alias("_text")), "sizes")
    n = base.count()
    sources = materialise(spark, source_targets(spark, base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))), "targets")
    # A null source needs a key that can be joined.
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    ranks = hot_join(base.select("_id", "_row", "size", "_text", key.alias("_key")), sources.select(key.alias("_key"), "_n", "_rank", "source_size", "target"), "_key", "_n", n)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    buckets = max(1, -(-n // BUCKET))
    rows = ranks.select("_id", "_row", "size", "_rank", F.pmod(F.xxhash64("_id", "size", "_text"), F.lit(buckets)).alias("_bucket"), (rate - F.floor(rate)).alias("_f"), F.xxhash64("_text", "_id", F.lit(seed)).alias("_h"), F.lit(True).alias("_open"))
    settled: list[DataFrame] = []
    schema = "_id long, _row string, size long, _rank long, _bucket long, _f double, _h long, _open boolean"
    while True:
        dealt = rows.repartition("_rank", "_bucket").sortWithinPartitions("_rank", "_bucket", F.desc("size"), "_h", "_id", "_row")
        level = materialise(spark, dealt.mapInArrow(lambda it: settle(it, seed), schema), "rounded")
        settled.append(level.filter("not _open"))
        if buckets == 1:
            break
        buckets = -(-buckets // FAN_IN)
        rows = level.filter("_open").withColumn("_bucket", F.floor(F.col("_bucket") / FAN_IN).cast("long"))
    done = level.filter("_open").withColumn("_f", F.when(F.col("_f") >= 0.5, 1.0).otherwise(0.0))
    for x in settled:
        done = done.unionByName(x)
    out = hot_join(done.select("_id", "_row", "size", "_f", "_rank"), sources.select("_rank", "_n", "source", "source_size", "target"), "_rank", "_n", n)
    copies = F.floor(rate).cast("long") + F.col("_f").cast("long")
    out = out.select("_id", "_row", "size", "source", "source_size", "target", F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long")).alias("copies"))
    return out.select(F.col("_id").alias(id_col), *([F.col("_row").alias(row_col)] if row_col else []), "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
