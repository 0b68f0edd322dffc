"""Token-ID output: sequences in training order, in binary shards of records of fixed stride."""

import array
import base64
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, same_splits, scratch, small_batches, whole_number

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the published pattern that splits text before byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same without looking ahead, for texts in which no two white spaces are neighbours.
LONE = PATTERN.replace(r"\s+(?!\S)|\s+", r"\s")
NEIGHBOURS = re.compile(r"\s\s")
#: doc_id, part, number of tokens, whether there is a doc_id; then the tokens, and a line feed that ends the record.
HEADER = "<qIIB3x"
HEADER_BYTES = struct.calcsize(HEADER)


class Tokenizer:
    """A byte-level tokenizer whose tokens are 16-bit numbers; `end` stands after each text."""

    def __init__(self, vocabulary: bytes) -> None:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.end = len(ranks)
        self.encoding, self.lone = (tiktoken.Encoding("sparkloom", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (PATTERN, LONE))

    def encode(self, text: str | None) -> bytes:
        encoding = self.encoding if text and NEIGHBOURS.search(text) else self.lone
        return array.array("H", [*(encoding.encode_ordinary(text) if text else ()), self.end]).tobytes()


@lru_cache(maxsize=1)
def tokenizer(vocabulary: bytes) -> Tokenizer:
    """The tokenizer of a vocabulary, made once in a worker process."""
    return Tokenizer(vocabulary)


class Feistel:
    """A keyed permutation of range(n): a Feistel network over an even number of bits, walked along its cycles
    until it comes back into the range."""

    def __init__(self, n: int, key: int, rounds: int = 6) -> None:
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8])) for r in range(rounds)]
        self.mask = np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in self.keys:
            h = (right ^ k) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h ^ (h >> np.uint64(29))) & self.mask)
        return (left << np.uint64(self.half)) | right

    def slots(self, index: np.ndarray) -> np.ndarray:
        out = self._once(index.astype(np.uint64))
        while (far := out >= self.n).any():
            out[far] = self._once(out[far])
        return out.astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch], vocabulary: bytes, length: int) -> Iterator[pa.RecordBatch]:
    """The number of sequences of the task's texts."""
    encode, n = tokenizer(vocabulary).encode, 0
    for batch in in_slices(batches):
        n += sum(-(-len(encode(t)) // (2 * length)) for t in batch.column(1).to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], names=["task", "n"])


def _place(batches: Iterable[pa.RecordBatch], vocabulary: bytes, length: int, ranges: dict[int, tuple[int, int]], order: Feistel, per_shard: int) -> Iterator[pa.RecordBatch]:
    """Every sequence with its slot; tokens are compressed for the shuffle."""
    encode, packer = tokenizer(vocabulary).encode, zstandard.ZstdCompressor(level=3)
    at, end = ranges.get(TaskContext.get().partitionId(), (0, 0))
    for batch in in_slices(batches, 250):
        rows: list[bytes] = []
        for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            tokens = encode(text)
            for part, low in enumerate(range(0, len(tokens), 2 * length)):
                own = tokens[low : low + 2 * length]
                rows.append(struct.pack(HEADER, key or 0, part, len(own) // 2, key is not None) + packer.compress(own))
        slots = order.slots(np.arange(at, at + len(rows)))
        at += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array((slots // per_shard).astype(np.int32)), pa.array(slots), pa.array(rows, pa.binary())], names=["shard", "slot", "record"])
    if at != end:
        raise ValueError("the input gave other rows than when it was counted; write it to a table first")


def _expand(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in in_slices(batches):
        rows = [r[:HEADER_BYTES] + unpacker.decompress(r[HEADER_BYTES:]).ljust(2 * length, b"\xff") for r in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])


def _layout(length: int) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("part", "<u4"), ("n", "<u4"), ("has", "u1"), ("_", "u1", 3), ("tokens", "u1", 2 * length), ("end", "u1")])


def _rows(records: bytes, length: int) -> np.ndarray:
    rows = np.frombuffer(records, _layout(length))
    if (rows["end"] != 10).any():
        raise ValueError("a shard has a record without its end")
    return rows


def _records(batches: Iterable[pa.RecordBatch], length: int, per_shard: int, with_tokens: bool) -> Iterator[pa.RecordBatch]:
    stride = _layout(length).itemsize
    for batch in in_slices(batches, 2000):
        shard, at, records = batch.column(0), batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_pylist()
        if any(len(r) != stride for r in records):
            raise ValueError("a shard is not a whole number of records")
        rows = _rows(b"".join(records), length)
        own = [t[: 2 * n].tobytes() for t, n in zip(rows["tokens"], rows["n"].tolist(), strict=True)]
        slots = shard.to_numpy().astype(np.int64) * per_shard + at
        columns = [pa.array(rows["doc_id"], mask=rows["has"] == 0), pa.array(rows["part"].astype(np.int64)), pa.array(slots), shard, pa.array(at * stride), pa.array(rows["n"].astype(np.int64)), pa.array([zlib.crc32(t) for t in own], pa.int64())]
        names = ["doc_id", "part", "slot", "shard", "byte_offset", "n_tokens", "tokens_crc32"]
        yield pa.RecordBatch.from_arrays([*columns, *([pa.array([np.frombuffer(t, np.uint16) for t in own], pa.list_(pa.int32()))] if with_tokens else [])], names=names + ["tokens"] * with_tokens)


def _files(spark: SparkSession, path: str) -> DataFrame:
    shard = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int")
    return spark.read.format("binaryFile").load(f"{path}/shards").withColumn("shard", shard)


def write_shards(spark: SparkSession, docs: DataFrame, path: str, length: int = 512, shard_bytes: int = 40_000_000, key: int = 0, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Writes all token sequences of docs to path/shards in training order; returns the manifest, also written.

    A document's tokens and an end token are cut into sequences of `length`, the last one padded. A first pass counts
    the sequences of each partition, so that all n have numbers; a keyed permutation of range(n) gives each its
    global slot in the second. Slot s is record s % records of shard s // records: equal ranges of slots are the
    shards, sorted by slot, and no sort of the corpus is needed. Each task writes one shard through Spark's file
    writer, which commits whole files only and reaches any file system that Spark does.

    Texts are tokenized twice, which costs less than to keep all tokens in between. The docs must give the same rows
    in the same partitions in both passes, as tables do (their splits are held); else an error is raised. The
    vocabulary is read on the driver and broadcast; tokens are 16-bit numbers. Null texts are empty: one sequence of
    the end token. Null ids are marked in the record; ids that are no integers raise ValueError. Repeated rows are
    written once each. An empty table gives a manifest without shards. Other columns are not read.
    """
    small_batches(spark)
    with open(vocabulary, "rb") as f:
        words = spark.sparkContext.broadcast(f.read())
    rows = docs.select(whole_number(docs, id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    stride = _layout(length).itemsize
    per_shard = max(1, shard_bytes // stride)
    with same_splits(spark):
        ranges, n = {}, 0
        for task, k in sorted(tuple(r) for r in rows.mapInArrow(lambda it: _count(it, words.value, length), "task int, n long").collect()):
            ranges[task] = (n, n + k)
            n += k
        if n:
            order = Feistel(n, key)
            placed = rows.mapInArrow(lambda it: _place(it, words.value, length, ranges, order, per_shard), "shard int, slot long, record binary")
            dealt = placed.repartitionById(-(-n // per_shard), F.col("shard")).sortWithinPartitions("slot").select("record")
            dealt.mapInArrow(lambda it: _expand(it, length), "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/shards")
    words.unpersist()
    manifest = {"sequences": n, "length": length, "stride": stride, "records": per_shard, "key": key, "vocabulary": vocabulary.rpartition("/")[2]}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/manifest")
    return manifest


def _manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first()[0])


def read_shards(spark: SparkSession, path: str, with_tokens: bool = False, first_slot: int = 0) -> DataFrame:
    """Records of the shards: doc_id, part, slot, shard, byte_offset, n_tokens, tokens_crc32, and tokens if asked for.

    Shards before the one of first_slot are not opened; see resume for reading from an offset on. Every record's end
    is checked, and every shard's length.
    """
    small_batches(spark)
    manifest = _manifest(spark, path)
    schema = "doc_id long, part long, slot long, shard int, byte_offset long, n_tokens long, tokens_crc32 long" + ", tokens array<int>" * with_tokens
    n, length, stride, per_shard = (manifest[k] for k in ("sequences", "length", "stride", "records"))
    if not n:
        return spark.createDataFrame([], schema)
    files = _files(spark, path).filter(F.col("shard") >= first_slot // per_shard)
    own = F.least(F.lit(per_shard), n - F.col("shard").cast("long") * per_shard) * stride
    content = F.when(F.col("length") == own, F.col("content")).otherwise(F.raise_error(F.lit("a shard has not its length")).cast("binary"))
    # Whole shards would meet in one Arrow batch; cut into records they come in batches of a few MB.
    places = F.sequence(F.lit(0), (F.col("length") / stride - 1).cast("int"))
    # The lambda's c is the shard itself; a column named inside the inner one would be copied for each record.
    cut = F.transform(F.array(content), lambda c: F.transform(places, lambda i: F.substring(c, i * stride + 1, F.lit(stride))))
    records = files.select("shard", F.posexplode(F.flatten(cut)).alias("at", "record"))
    return records.mapInArrow(lambda it: _records(it, length, per_shard, with_tokens), schema).filter(F.col("slot") >= first_slot)


def resume(spark: SparkSession, path: str, slot: int = 0, records: int = 1000) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(slot, doc_id, part, tokens) one after the other from a slot on, as a training loop reads them.

    The slot's shard is opened at its offset, and `records` records are in memory at once; what comes before is not
    read. Files are reached through Spark's file systems.
    """
    manifest = _manifest(spark, path)
    n, length, stride, per_shard = (manifest[k] for k in ("sequences", "length", "stride", "records"))
    files = {r.shard: r.path for r in _files(spark, path).select("shard", "path").collect()} if slot < n else {}
    jvm = spark._jvm
    while slot < n:
        place = jvm.org.apache.hadoop.fs.Path(files[slot // per_shard])
        stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
        try:
            stream.seek(slot % per_shard * stride)
            end = min(n, (slot // per_shard + 1) * per_shard)
            while slot < end:
                rows = _rows(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, min(records, end - slot) * stride), length)
                for row in rows:
                    yield slot, int(row["doc_id"]) if row["has"] else None, int(row["part"]), np.frombuffer(row["tokens"].tobytes(), np.uint16)[: row["n"]]
                    slot += 1
        finally:
            stream.close()


def decode(tokens: list[int], vocabulary: str = VOCABULARY) -> str:
    """The text of a document's tokens, end tokens left out."""
    with open(vocabulary, "rb") as f:
        own = tokenizer(f.read())
    return own.encoding.decode([t for t in tokens if t != own.end])


def token_output(spark: SparkSession, docs: DataFrame, **options: object) -> DataFrame:
    """Writes the shards to a new place in the shared folder and returns the records as read back from them."""
    path = scratch(spark, "shards")
    write_shards(spark, docs, path, **options)
    return read_shards(spark, path)
