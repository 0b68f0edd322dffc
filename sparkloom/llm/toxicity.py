"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

import copy
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, hash_bound, in_slices, mark, materialise, small_batches

#: Labelled documents of each label that a model is fitted on (documented bound), bits of the hash, bytes of a stem.
SAMPLE, BITS, STEM = 6000, 20, 4
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))


def features(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Distinct buckets of the text's words, stems, pairs of neighbours and pairs with one word between.

    A stem is the first STEM bytes of a longer word: inflected forms that were never seen share it.
    """
    words = text.translate(_TABLE).split() if text else []
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    mix = lambda a, b, k: (a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(k)) * np.uint64(0xC2B2AE3D27D4EB4F)
    keys = [(h + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)]
    stems = np.fromiter((zlib.crc32(w[:STEM]) for w in words if len(w) > STEM), np.uint64)
    keys.append((stems + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93))
    keys += [mix(h[:-gap], h[gap:], gap) for gap in (1, 2) if len(h) > gap]
    return np.unique(np.concatenate(keys) >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """FTRL-proximal with a learning rate for each coordinate; L1 keeps most weights at zero."""

    def __init__(self, bits: int = BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 8.0, l2: float = 0.5) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def bias(self) -> float:
        return -self.bias_z / ((self.beta + self.bias_n**0.5) / self.alpha)

    def learn(self, at: np.ndarray, label: int, weight: float) -> None:
        w, b = self.weights(at), self.bias()
        g = weight * (1 / (1 + np.exp(-np.clip(w.sum() + b, -30, 30))) - label)
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += g * g
        self.bias_z += g - ((self.bias_n + g * g) ** 0.5 - self.bias_n**0.5) / self.alpha * b
        self.bias_n += g * g


class Weights:
    """What is broadcast: the buckets whose weight is not zero, and the bias."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bias: float, bits: int) -> None:
        self.keys, self.values, self.bias, self.bits = keys, values, bias, bits

    def score(self, text: bytes | None) -> float:
        got = features(text, self.bits)
        total = self.bias
        if len(self.keys) and len(got):
            at = np.minimum(np.searchsorted(self.keys, got), len(self.keys) - 1)
            total += self.values[at][self.keys[at] == got].sum()
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _featured(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        blobs = [features(t, bits).astype(np.int32).tobytes() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["_u", "label", "at"])


def _train(batches: Iterable[pa.RecordBatch], model: Ftrl, weight: dict[int, float]) -> Iterator[pa.RecordBatch]:
    """One pass over the bounded sample in one task, batch by batch: the coordinates that have been met, and the bias (-1)."""
    for batch in in_slices(batches):
        for y, at in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            model.learn(np.frombuffer(at, np.int32), y, weight[y])
    keys = np.flatnonzero(model.n)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, keys], pa.int64()), pa.array(np.r_[model.bias_z, model.z[keys]]), pa.array(np.r_[model.bias_n, model.n[keys]])], names=["key", "z", "n"])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, bits: int = BITS, epochs: int = 4) -> Weights:
    """Fits on about so many labelled documents of each label, chosen by a hash of the id.

    labels may hold other labels than 0 and 1, nulls, or rows without a document: those are left out; if a
    document has several labels, the larger counts. The chosen ids, at most some twice the sample, are broadcast,
    so documents are not shuffled. The sample's features are written in the order of the hash, and each epoch is
    one task that reads them in batches, from the state of the epoch before: memory is that of two arrays of 2 ** bits
    numbers, however long the texts are. Both labels weigh the same in sum, within a factor of three.
    """
    small_batches(spark)
    u = F.xxhash64(F.lit("toxic"), F.col("_id")).bitwiseAND((1 << 63) - 1)
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter("_id is not null and label in (0, 1)").groupBy("_id").agg(F.max("label").alias("label")).withColumn("_u", u)
    sizes = dict(tuple(r) for r in marked.groupBy("label").count().collect())
    bound = {k: hash_bound(sample, n) for k, n in sizes.items()}
    chosen = marked.filter(F.col("_u") <= F.when(F.col("label") == 1, bound.get(1, -1)).otherwise(bound.get(0, -1)))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")).join(F.broadcast(chosen), "_id")
    rows = texts.select("_u", "label", "_text").mapInArrow(lambda it: _featured(it, bits), "_u long, label int, at binary")
    begun = mark()
    rows = materialise(spark, rows.repartition(1).sortWithinPartitions("_u", "label", "at"), "features")
    seen = {0: 0, 1: 0} | dict(tuple(r) for r in rows.groupBy("label").count().collect())
    weight = {0: 1.0, 1: min(3.0, max(1.0, seen[0] / max(seen[1], 1)))}
    model = Ftrl(bits)
    for _ in range(epochs if sum(seen.values()) else 0):
        shared = spark.sparkContext.broadcast(model)
        got = rows.coalesce(1).mapInArrow(lambda it, m=shared: _train(it, copy.deepcopy(m.value), weight), "key long, z double, n double").toArrow()
        shared.unpersist()
        key, z, n = (got[c].to_numpy() for c in ("key", "z", "n"))
        model, at = Ftrl(bits), key[key >= 0]
        model.z[at], model.n[at] = z[key >= 0], n[key >= 0]
        model.bias_z, model.bias_n = float(z[key < 0][0]), float(n[key < 0][0])
    discard(spark, begun, begun + 1)
    w = model.weights(slice(None))
    keys = np.flatnonzero(w)
    return Weights(keys, w[keys], model.bias(), bits)


def _score(batches: Iterable[pa.RecordBatch], weights: Weights) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        got = np.array([weights.score(t) for t in batch.column(batch.num_columns - 1).to_pylist()], np.float64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got), pa.array((got >= 0.5).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])


def score(spark: SparkSession, docs: DataFrame, weights: Weights, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Columns keep, score (0 to 1) and predicted (score >= 0.5) of each row of docs; only the text decides.

    Null, empty and wordless texts get the score of the bias alone. A feature counts once however often it
    occurs, so very long texts are no more toxic than short ones for their length. Repeated rows keep a row each;
    an empty table gives an empty one; columns that are not named are not read.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(weights)
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text_col).cast("binary").alias("_text"))
    schema = ", ".join([f"`_k{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)] + ["score double", "predicted int"])
    out = rows.mapInArrow(lambda it: _score(it, shared.value), schema)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "score", "predicted")
