"""Benchmark decontamination: a prefix-filtered set join of item windows with documents."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, small_batches

#: Windows of items that one block of the index holds; a larger benchmark is joined in several blocks.
BLOCK_WINDOWS = 2_000_000
#: Candidate places of a document that are compared in step.
STEP = 1 << 16
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: A-Z to lower case; whatever is no part of a word becomes a space.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of 0-9, a-z and bytes from 0x80."""
    return text.translate(_TABLE).split() if text else []


def shingle_keys(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of every width consecutive ids; equal keys are only candidates, which are verified."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(width):
        key = (key ^ ids[k : k + n].astype(np.uint64)) * _MULTIPLIER
        key ^= key >> np.uint64(29)
    return key


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a sorted array, and where the run of each begins (and the last one ends)."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.r_[first, len(keys)]


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... so many of each, one after the other."""
    return np.repeat(begins - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum()) if len(sizes) else np.zeros(0, np.int64)


class Windows:
    """Distinct windows of one length, as places in the block's words, with the items of each."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, items: np.ndarray, length: int, width: int) -> None:
        self.length, self.width = length, min(width, length)
        key = shingle_keys(words, length)[starts]
        order = np.lexsort((items, key))
        starts, items, key = starts[order], items[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        for k in range(length):  # equal hashes are told apart; at worst a window is there twice
            new[1:] |= words[starts[1:] + k] != words[starts[:-1] + k]
        first = np.flatnonzero(new)
        self.starts, self.items, self.item_at = starts[first].astype(np.int32), items.astype(np.int32), np.r_[first, len(items)].astype(np.int32)
        #: Windows sorted by their prefix, the rarest shingle: its key, where its run of windows begins, and their offsets.
        self.prefix, self.at = np.zeros(0, np.uint64), np.zeros(1, np.int64)
        self.window = self.offset = np.zeros(0, np.int32)

    def order(self, words: np.ndarray, known: np.ndarray, frequency: np.ndarray) -> None:
        """Files each window under its rarest shingle (then the smallest key, then the first): to contain a window
        is to contain its prefix of one token. A window whose rarest shingle is in no document is left out."""
        keys = shingle_keys(words, self.width)
        best, best_key, offset = np.zeros(0), np.zeros(0, np.uint64), np.zeros(len(self.starts), np.int32)
        for k in range(self.length - self.width + 1):
            key = keys[self.starts + k]
            n = frequency[np.searchsorted(known, key)]
            if k == 0:
                best, best_key = n, key
                continue
            better = (n < best) | ((n == best) & (key < best_key))
            best, best_key = np.where(better, n, best), np.where(better, key, best_key)
            offset[better] = k
        there = np.flatnonzero(best > 0)
        there = there[np.argsort(best_key[there], kind="stable")]
        self.prefix, self.at = _runs(best_key[there])
        self.window, self.offset = there.astype(np.int32), offset[there]


class Index:
    """Windows of one block of benchmark items over a vocabulary of the block's own words, all in a few arrays."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int, width: int) -> None:
        """Words of items, one after the other; a piece of a long item begins with the last window - 1 words before."""
        self.vocabulary: dict[bytes, int] = {}
        names: dict[str, int] = {}
        parts, starts, owners = [], {}, {}
        size = 0
        for item, found in items:
            if not found:
                continue
            parts.append(np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found), np.int32, len(found)))
            length = min(window, len(found))
            own = np.arange(size, size + len(found) - length + 1)
            starts.setdefault(length, []).append(own)
            owners.setdefault(length, []).append(np.full(len(own), names.setdefault(item, len(names))))
            size += len(found)
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.names = list(names)
        self.windows = [Windows(self.words, np.concatenate(starts[n]), np.concatenate(owners[n]), n, width) for n in sorted(starts)]
        #: Items shorter than a shingle are shingles of their own width. Keys are those of the windows' shingles only.
        self.keys: dict[int, np.ndarray] = {}
        for w in self.windows:
            keys = shingle_keys(self.words, w.width)
            own = np.unique(np.concatenate([keys[w.starts + k] for k in range(w.length - w.width + 1)]))
            self.keys[w.width] = np.union1d(self.keys.get(w.width, own[:0]), own)

    def encode(self, text: bytes | None) -> np.ndarray:
        """Word numbers; words of no item are -1."""
        found = words(text)
        return np.fromiter(map(self.vocabulary.get, found, (-1 for _ in found)), np.int32, len(found))

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(width, places among keys) of the distinct shingles of a document that are shingles of an item."""
        for k, own in self.keys.items():
            keys = shingle_keys(ids, k)
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            yield k, np.unique(at[own[at] == keys])

    def order(self, frequency: dict[int, np.ndarray]) -> None:
        """Files the windows, given the number of documents with each of keys; what only this needs is dropped."""
        for w in self.windows:
            w.order(self.words, self.keys[w.width], frequency[w.width])
        self.keys = {}

    def hits(self, text: bytes | None) -> tuple[int, np.ndarray, list[str]]:
        """Number of words, mask of hit words, items with occurring windows."""
        ids = self.encode(text)
        mask, found = np.zeros(len(ids) + 1, np.int64), []
        keys = {k: shingle_keys(ids, k) for k in {w.width for w in self.windows if len(w.prefix)}}
        for w in self.windows:
            if not len(w.prefix) or not len(keys[w.width]):
                continue
            near = np.minimum(np.searchsorted(w.prefix, keys[w.width]), len(w.prefix) - 1)
            here = np.flatnonzero(w.prefix[near] == keys[w.width])
            near = near[here]
            for at in range(0, len(here), STEP):  # a place has a window mostly, or a few
                own = near[at : at + STEP]
                sizes = w.at[own + 1] - w.at[own]
                for low, high in _parts(sizes, STEP):
                    filed = _spread(w.at[own[low:high]], sizes[low:high])
                    start = np.repeat(here[at + low : at + high], sizes[low:high]) - w.offset[filed]
                    window = w.window[filed]
                    # Bounds of position and length, then the window in full.
                    fits = (start >= 0) & (start + w.length <= len(ids))
                    start, window = start[fits], window[fits]
                    for k in range(w.length):
                        same = ids[start + k] == self.words[w.starts[window] + k]
                        start, window = start[same], window[same]
                    np.add.at(mask, start, 1)
                    np.add.at(mask, start + w.length, -1)
                    window = np.unique(window)
                    found.append(w.items[_spread(w.item_at[window], w.item_at[window + 1] - w.item_at[window])])
        names = [self.names[i] for i in np.unique(np.concatenate(found)).tolist()] if found else []
        return len(ids), np.cumsum(mask[:-1]) > 0, sorted(names)


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of places with so many windows in all, or of one place with more."""
    sums, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + most, side="right")))
        yield at, to
        at = to


def _frequencies(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Counts of the documents that have each shingle, summed for the partition."""
    total = {k: np.zeros(len(x), np.int64) for k, x in index.keys.items()}
    for batch in in_slices(batches):
        for text in batch.column(0).to_pylist():
            for k, at in index.occurrences(index.encode(text)):
                total[k][at] += 1
    for k, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at), pa.array(n[at])], names=["width", "at", "n"])


def _join(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        got = [index.hits(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        # Hit words as [start, end) spans, so that the blocks of a large benchmark can be put together.
        spans = [np.flatnonzero(np.diff(np.r_[0, m.astype(np.int8), 0])).tolist() for _, m, _ in got]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([n for n, _, _ in got], pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array([f for _, _, f in got], pa.list_(pa.string()))],
            names=[*batch.schema.names[:-1], "n_words", "spans", "items"],
        )


def _blocks(items: DataFrame, window: int, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Words of items, about so many in a block; a long item is cut, with window - 1 words in both pieces."""
    block, room = [], most
    for item, text in items.toLocalIterator():
        found = words(bytes(text))
        for at in range(0, max(1, len(found) - window + 1), most):
            piece = found[at : at + most + window - 1]
            if block and len(piece) > room:
                yield block
                block, room = [], most
            block.append((item, piece))
            room -= len(piece)
    if block:
        yield block


def decontaminate(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_windows: int = BLOCK_WINDOWS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row for each row of docs: id, columns keep, n_words, spans of hit words, n_hit, items (sorted), n_items.

    A window is so many consecutive words of an item, or a whole shorter item. Sets are the shingles of a window,
    five words each. A first pass counts the documents that have each shingle of the benchmark; a window is then
    filed under its rarest shingle alone (containment of all needs a prefix of one), a window whose rarest shingle
    is in no document is dropped, and the second pass looks for those tokens, applies the bounds of position and
    length and compares the window word by word.

    The index of about block_windows windows (some 60 bytes each) is broadcast; a larger benchmark takes two scans
    for each block, and the blocks' spans and items are united. No documents are shuffled, except to unite blocks.

    Null texts have no words; null items are left out; a null item id counts as the empty id; repeated items count
    once per id; repeated documents keep a row each; an empty benchmark hits nothing. Columns that are not named
    are not read.
    """
    small_batches(spark)
    cols = list(dict.fromkeys([id_col, *keep]))
    rows = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], F.col(text_col).cast("binary").alias("_text"))
    items = benchmark.filter(F.col(text_col).isNotNull()).select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(text_col).cast("binary"))
    schema = ", ".join(f"`_k{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(cols)) + ", n_words long, spans array<long>, items array<string>"
    found: list[DataFrame] = []
    for block in _blocks(items, window, block_windows):
        index = Index(block, window, shingle)
        if index.windows:
            asked = spark.sparkContext.broadcast(index)
            counted = rows.select("_text").mapInArrow(lambda it, x=asked: _frequencies(it, x.value), "width int, at long, n long").groupBy("width", "at").agg(F.sum("n").alias("n")).toArrow()
            asked.unpersist()
            frequency = {k: np.zeros(len(x), np.int64) for k, x in index.keys.items()}
            for k, own in frequency.items():
                of = counted.filter(pc.equal(counted["width"], k))
                own[of["at"].to_numpy()] = of["n"].to_numpy()
            index.order(frequency)
        shared = spark.sparkContext.broadcast(index)
        found.append(rows.mapInArrow(lambda it, x=shared: _join(it, x.value), schema))
    if not found:
        none = spark.sparkContext.broadcast(Index([], window, shingle))
        found.append(rows.mapInArrow(lambda it: _join(it, none.value), schema))
    out = found[0] if len(found) == 1 else _united(rows, found, schema)
    pairs = F.expr("transform(filter(sequence(0, greatest(size(spans), 2) - 1), i -> i % 2 = 0 and i < size(spans)), i -> spans[i + 1] - spans[i])")
    n_hit = F.aggregate(pairs, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(cols)], "n_words", "spans", n_hit.alias("n_hit"), "items", F.size("items").cast("long").alias("n_items"))


def _union_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        out = []
        for n, many in zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            mask = np.zeros(n + 1, np.int64)
            for s in many:
                np.add.at(mask, s[::2], 1)
                np.add.at(mask, s[1::2], -1)
            out.append(np.flatnonzero(np.diff(np.r_[0, (np.cumsum(mask[:-1]) > 0).astype(np.int8), 0])).tolist())
        yield batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.array(out, pa.list_(pa.int64())))


def _united(rows: DataFrame, found: list[DataFrame], schema: str) -> DataFrame:
    """Rows of several blocks by the documents' place in the scan, which is the same in each."""
    keys = rows.columns[:-1]
    place = [x.withColumn("_at", F.monotonically_increasing_id()) for x in found]
    every = place[0]
    for x in place[1:]:
        every = every.unionByName(x)
    first = [F.any_value(k).alias(k) for k in keys]
    one = every.groupBy("_at").agg(*first, F.max("n_words").alias("n_words"), F.collect_list("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return one.drop("_at").select(*keys, "n_words", "spans", "items").mapInArrow(_union_spans, schema)
