"""LM scoring by prediction by partial matching over bytes, beside a word-count baseline."""

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, materialise, small_batches

#: Bytes of the longest context; runs of ORDER + 1 bytes and words that are looked up without a join; slots for the runs.
ORDER, RUNS, HEAD, SLOTS = 5, 1 << 19, 100_000, 1 << 21
#: End of a text; it also stands before its beginning. It is in no normalised text.
END = 10
#: Symbols that are scored in step with those of other texts; each piece starts from the ORDER bytes before it.
PIECE = 512


def normalised(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split() if text else []


def grams(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ORDER + 1 symbols as numbers, with their counts; each text starts after ORDER ends."""
    pad = bytes([END]) * ORDER
    buffer = pad + pad.join(b" ".join(t) + bytes([END]) for t in texts)
    b = np.frombuffer(buffer, np.uint8).astype(np.uint64)
    n = len(b) - ORDER
    key = np.zeros(n, np.uint64)
    for k in range(ORDER + 1):
        key = (key << np.uint64(8)) | b[k : k + n]
    key = np.sort(key[~((b[ORDER:] == END) & (b[ORDER - 1 : -1] == END))])
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    keys, counts = key[first], np.diff(np.r_[first, len(key)])
    empty = sum(not t for t in texts)  # an empty text is an end after ends
    if empty:
        keys, counts = np.r_[keys, np.uint64(int.from_bytes(bytes([END]) * (ORDER + 1)))], np.r_[counts, empty]
    return keys, counts


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (key: 1, word) and of runs of symbols (key: 0, run), summed for the partition."""
    words: Counter = Counter()
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out_words() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array([b"\x01" + w for w in words], pa.binary()), pa.array(list(words.values()), pa.int64())], names=["key", "n"])
        words.clear()
        return rows

    def out_grams() -> pa.RecordBatch:
        raw = np.ascontiguousarray(keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - ORDER - 2 :])
        fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(ORDER + 2), len(keys), [None, pa.py_buffer(raw)])
        return pa.RecordBatch.from_arrays([fixed.cast(pa.binary()), pa.array(counts, pa.int64())], names=["key", "n"])

    for batch in in_slices(batches, 500):
        texts = [normalised(t) for t in batch.column(0).to_pylist()]
        for t in texts:
            words.update(t)
        k, c = grams(texts)
        keys, at = np.unique(np.concatenate([keys, k]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([counts, c]), minlength=len(keys)).astype(np.int64)
        if len(words) > 200_000:
            yield out_words()
        if len(keys) > 1_000_000:
            yield out_grams()
            keys, counts = keys[:0], counts[:0]
    if words:
        yield out_words()
    if len(keys):
        yield out_grams()


def context_key(context: bytes) -> int:
    """A context as a number: its length, then its bytes."""
    return len(context) << 8 * ORDER | int.from_bytes(context)


class Trie:
    """The trie of byte contexts as an automaton: for each context and symbol the code length and next context.

    This is the model in one process, for texts whose contexts fit there; lm_scores gives the same scores by joins.

    A symbol that follows a context is coded there, by method D: half a count of each distinct symbol goes to the
    escape. An escape drops the context's first byte and excludes all symbols of the longer contexts; below the
    empty context all bytes that are left share the chance alike. As every context's suffixes are contexts too,
    the chances of all 256 bytes after any context add up to 1.
    """

    def __init__(self, contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray) -> None:
        """Rows of a context (a number, see context_key), the symbol after it and how often it was there."""
        names = np.unique(np.r_[np.int64(0), contexts])  # shorter contexts come first
        length, value = names >> 8 * ORDER, names & ((1 << 8 * ORDER) - 1)
        seen = np.unique(symbols[contexts == 0]).astype(np.int64)
        #: Byte to class; bytes that were never seen share the last one.
        self.classes = np.full(256, len(seen), np.int64)
        self.classes[seen] = np.arange(len(seen))
        self.width = len(seen) + 1
        table = np.zeros((len(names), self.width), np.float32)
        table[np.searchsorted(names, contexts), self.classes[symbols]] = counts
        suffix, cut = np.zeros(len(names), np.int64), length - 1
        for _ in range(ORDER):  # the longest suffix that is a context, mostly one byte shorter
            cut = np.maximum(cut, 0)
            key = (cut << 8 * ORDER) | (value & ((1 << 8 * cut) - 1))
            at = np.minimum(np.searchsorted(names, key), len(names) - 1)
            suffix = np.where((suffix == 0) & (names[at] == key), at, suffix)
            cut = cut - 1
        parent_key = (np.maximum(length - 1, 0) << 8 * ORDER) | (value >> 8)
        parent = np.minimum(np.searchsorted(names, parent_key), len(names) - 1)
        last = self.classes[value & 255]
        child = (length > 0) & (names[parent] == parent_key) & (last < len(seen))
        self.next = np.zeros((len(names), self.width), np.uint16 if len(names) <= 65_536 else np.int32)
        for n in range(ORDER + 1):
            own = np.flatnonzero(length == n)
            if n:
                self.next[own] = self.next[suffix[own]]
            below = np.flatnonzero(child & (length == n + 1))
            self.next[parent[below], last[below]] = below
        self.code = np.zeros((len(names), self.width), np.float32)
        for at in range(0, len(names), 2048):
            self.code[at : at + 2048] = self._codes(table, suffix, np.arange(at, min(at + 2048, len(names))), 256 - len(seen))

    def _codes(self, counts: np.ndarray, suffix: np.ndarray, nodes: np.ndarray, unseen: int) -> np.ndarray:
        out = np.zeros((len(nodes), self.width))
        done, escape, at = np.zeros(out.shape, bool), np.ones(len(nodes)), nodes.copy()
        going = np.ones(len(nodes), bool)
        while going.any():
            c = np.where(done | ~going[:, None], 0, counts[at]).astype(np.float64)
            total, kinds = c.sum(axis=1), (c > 0).sum(axis=1)
            some = total > 0
            safe = np.where(some, total, 1)[:, None]
            out = np.where(c > 0, escape[:, None] * (c - 0.5) / safe, out)
            escape = np.where(some, escape * kinds / (2 * safe[:, 0]), escape)
            done |= c > 0
            going &= at > 0
            at = suffix[at]
        left = unseen + (~done[:, :-1]).sum(axis=1)
        out = np.where(done, out, (escape / np.maximum(left, 1))[:, None])
        return np.log10(np.maximum(out, 1e-300))

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """log10 of each text's chance, its end included; pieces of all texts go through the automaton in step."""
        pad = bytes([END]) * ORDER
        streams = [b" ".join(t) + bytes([END]) for t in texts]
        if not streams:
            return np.zeros(0)
        symbols = self.classes[np.frombuffer(pad + pad.join(streams), np.uint8)]
        lengths = np.array([len(s) for s in streams])
        starts = np.cumsum(np.r_[0, lengths[:-1] + ORDER]) + ORDER
        pieces = -(-lengths // PIECE)
        doc = np.repeat(np.arange(len(texts)), pieces)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, size = starts[doc] + place * PIECE, np.minimum(PIECE, lengths[doc] - place * PIECE)
        order = np.argsort(-size, kind="stable")
        begin, size, doc = begin[order], size[order], doc[order]
        state, total = np.zeros(len(doc), np.int64), np.zeros(len(doc))
        code, following = self.code.ravel(), self.next.ravel()
        for t in range(-ORDER, int(size[0])):
            n = len(size) if t < 0 else int(np.searchsorted(-size, -t, side="left"))  # pieces longer than t
            at = state[:n] * self.width + symbols[begin[:n] + t]
            if t >= 0:
                total[:n] += code[at]
            state[:n] = following[at]
        return np.bincount(doc, weights=total, minlength=len(texts))


class Scorer:
    """What is broadcast: code lengths of the most frequent runs and the most frequent words with log10 of count plus 1.

    A run is in one of two slots; one that finds both taken is not held, and is joined as the others are.
    """

    def __init__(self, runs: np.ndarray, codes: np.ndarray, head: dict[bytes, float], slots: int = SLOTS) -> None:
        """Runs as numbers, the most frequent first."""
        self.shift, self.head = np.uint64(65 - slots.bit_length()), head
        self.runs, self.codes = np.full(slots, 1 << 63, np.uint64), np.zeros(slots, np.float32)
        for k in (0, 1):
            at = self._slots(runs, k)
            free = self.runs[at] == 1 << 63
            _, first = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.runs[at[put]], self.codes[at[put]] = runs[put], codes[put]
            runs, codes = np.delete(runs, put), np.delete(codes, put)

    def _slots(self, runs: np.ndarray, k: int) -> np.ndarray:
        return ((runs * np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[k])) >> self.shift).astype(np.int64)

    def score(self, texts: list[list[bytes]], step: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The sum of each text's codes that are held; then text, run and how often it is there of all others."""
        if not texts:
            return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        pad = bytes([END]) * ORDER
        streams = [b" ".join(t) + bytes([END]) for t in texts]
        b = np.frombuffer(pad + pad.join(streams), np.uint8)
        lengths = np.array([len(s) for s in streams])
        starts = np.cumsum(np.r_[0, lengths[:-1] + ORDER])  # places count from the first symbol on
        total = np.zeros(len(b) - ORDER, np.float64)
        own = np.ones(len(total), bool)
        own[(starts[1:, None] - np.arange(1, ORDER + 1)).ravel()] = False
        places, others = [], []
        for at in range(0, len(total), step):
            n = min(step, len(total) - at)
            key = np.zeros(n, np.uint64)
            for k in range(ORDER + 1):
                key = (key << np.uint64(8)) | b[at + k : at + k + n]
            left = np.flatnonzero(own[at : at + n])
            for k in (0, 1):
                slot = self._slots(key[left], k)
                held = self.runs[slot] == key[left]
                total[at + left[held]] = self.codes[slot[held]]
                left = left[~held]
            places.append(at + left)
            others.append(key[left])
        doc = np.searchsorted(starts, np.concatenate(places), side="right") - 1
        both, n = np.unique((doc.astype(np.uint64) << np.uint64(48)) | np.concatenate(others), return_counts=True)
        return np.add.reduceat(total, starts), (both >> np.uint64(48)).astype(np.int64), both & np.uint64((1 << 48) - 1), n


def _run_keys(runs: np.ndarray) -> pa.Array:
    """Runs as the keys of rows: END, which is in no word, then the run."""
    raw = np.ascontiguousarray((runs | np.uint64(END << 8 * (ORDER + 1))).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - ORDER - 2 :])
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(ORDER + 2), len(runs), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _score(batches: Iterable[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    """A row for each text, and one for each of its distinct words and runs that are not broadcast."""
    row = TaskContext.get().partitionId() << 40
    get = scorer.head.get
    for batch in in_slices(batches, 250):
        first = row
        texts = [normalised(t) for t in batch.column(1).to_pylist()]
        scores, at, runs, times = scorer.score(texts)
        uid, word, n, doc, tokens, known, base, score = [], [], [], [], [], [], [], []
        for key, text, s in zip(batch.column(0).to_pylist(), texts, scores.tolist(), strict=True):
            total = in_head = 0
            rare: list[bytes] = []
            for v, w in zip(map(get, text), text, strict=True):
                if v is None:
                    rare.append(w)
                else:
                    total += v
                    in_head += 1
            tail = Counter(rare)
            # The text's own row gets a key that is no word, so that rows of texts are dealt evenly.
            uid += [row] * (1 + len(tail))
            word += [b" " + row.to_bytes(8), *tail]
            n += [None, *tail.values()]
            nothing = [None] * len(tail)
            for column, value in ((doc, key), (tokens, len(text) + 1), (known, in_head), (base, float(total)), (score, s)):
                column.append(value)
                column.extend(nothing)
            row += 1
        names = ["_uid", "_word", "_n", "_doc", "n_tokens", "_known", "_base", "score"]
        rows = pa.RecordBatch.from_arrays(
            [pa.array(uid, pa.int64()), pa.array(word, pa.binary()), pa.array(n, pa.int64()), pa.array(doc, batch.schema.field(0).type), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
            names=names,
        )
        yield rows
        if len(runs):
            yield pa.RecordBatch.from_arrays([pa.array(first + at, pa.int64()), _run_keys(runs), pa.array(times, pa.int64()), *(pa.nulls(len(runs), c.type) for c in rows.columns[3:])], names=names)


def _least(counts: DataFrame, most: int) -> int:
    """The smallest bound with which at most so many rows have n >= bound, among powers of 2 ** 0.125."""
    steps = counts.groupBy(F.floor(F.log2("n") * 8).alias("step")).count().collect()
    total, bound = 0, 1 << 62
    for step, n in sorted(((r[0], r[1]) for r in steps), reverse=True):
        total += n
        if total > most:
            break
        bound = math.ceil(2 ** (step / 8) - 1e-9)
    return bound


def _contexts(nodes: DataFrame) -> DataFrame:
    """Each context with the counts after it, and what is left for an escape from it.

    seen maps the symbols to their counts, total and kinds sum them up; rest and more are total and kinds of the
    context without its first byte, less the symbols that are seen here (these were seen there, too).
    """
    own = nodes.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.map_from_entries(F.collect_list(F.struct("symbol", "n"))).alias("seen"))
    suffix = F.expr(f"shiftleft((context >> {8 * ORDER}) - 1, {8 * ORDER}) | (context & (shiftleft(1L, cast(8 * ((context >> {8 * ORDER}) - 1) as int)) - 1))")
    below = own.select(F.col("context").alias("_suffix"), F.col("total").alias("_total"), F.col("kinds").alias("_kinds"), F.col("seen").alias("_seen"))
    again = F.expr("aggregate(map_keys(seen), 0L, (a, s) -> a + _seen[s])")
    return own.withColumn("_suffix", F.when(F.col("context") > 0, suffix)).join(below, "_suffix", "left").select("context", "total", "kinds", "seen", (F.col("_total") - again).alias("rest"), (F.col("_kinds") - F.col("kinds")).alias("more"))


def _unseen_codes(runs: DataFrame, contexts: DataFrame) -> DataFrame:
    """Code lengths of distinct runs (key) that are not in the training texts, by the contexts on the way of the escapes.

    Contexts of at most one byte are few and shared by many runs: these are broadcast.
    """
    run = F.conv(F.hex(F.substring("_word", 2, ORDER + 1)), 16, 10).cast("long")
    orders = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("o")
    context = F.expr(f"shiftleft(cast(o as long), {8 * ORDER}) | ((run >> 8) & (shiftleft(1L, 8 * o) - 1))")
    asked = runs.select("_word", run.alias("run"), orders).select("_word", "o", context.alias("context"), F.expr("cast(run & 255 as int)").alias("symbol"))
    few = 2 << 8 * ORDER
    found = asked.filter("o < 2").join(F.broadcast(contexts.filter(F.col("context") < few)), "context", "left").unionByName(asked.filter("o >= 2").join(contexts.filter(F.col("context") >= few), "context", "left"))
    step = F.struct("o", F.expr("seen[symbol]").alias("n"), "total", "kinds", "rest", "more")
    ways = found.groupBy("_word").agg(F.array_sort(F.collect_list(step)).alias("way"))
    ways = ways.withColumn("at", F.expr("coalesce(array_max(transform(filter(way, x -> x.n is not null), x -> x.o)), -1)")).withColumn("top", F.expr("coalesce(array_max(transform(filter(way, x -> x.total is not null), x -> x.o)), -1)"))
    start = "if(at = top, 0D, log10(way[top].kinds / (2 * way[top].total)))"
    escapes = "aggregate(filter(way, x -> x.o > at + 1 and x.rest > 0), 0D, (a, x) -> a + log10(x.more / (2 * x.rest)))"
    end = "case when at < 0 then -log10(greatest(256 - coalesce(way[0].kinds, 0), 1)) when at = top then log10((way[at].n - 0.5D) / way[at].total) else log10((way[at].n - 0.5D) / way[at + 1].rest) end"
    return ways.select("_word", F.expr(f"{start} + {escapes} + {end}").alias("_v"))


def lm_scores(spark: SparkSession, docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent_runs: int = RUNS, head: int = HEAD) -> DataFrame:
    """One row for each row of docs: id, n_tokens, n_known, train_tokens, base_score, score.

    One pass over all of train counts its words and its runs of ORDER + 1 bytes; Spark sums both. The model has all
    contexts of 0 to ORDER bytes with all their counts. A symbol's code length depends on its run only, so that a
    second pass over all of docs sums code lengths of the words with single spaces between and an end: at most
    `frequent_runs` runs and `head` words, the most frequent, are looked up in broadcast tables, and all others are
    joined with the full tables. Runs that are not in train get the code lengths of the escapes to shorter contexts.
    How much is broadcast changes no score (but for the rounding of 32-bit code lengths).

    base_score is the sum over tokens of log10((c + 1) / (N + V + 1)), the end counted as a token. Null texts are
    empty: they have one token, the end. Null ids stay; repeated rows keep a row each; without training rows all
    counts are 0 and every byte has the chance 1/256. An empty table gives an empty one; other columns are not
    read. Partitions of docs are identified by their place in the scan, which a lost executor does not change.
    """
    small_batches(spark)
    counts = train.select(F.col(text_col).cast("binary").alias("_text")).mapInArrow(_count, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = materialise(spark, counts.select((F.substring("key", 1, 1) == F.lit(b"\x01")).alias("is_word"), F.substring("key", 2, 1 << 30).alias("key"), "n"), "counts")
    texts = train.count()
    words = counts.filter("is_word").select(F.col("key").alias("_word"), "n")
    kinds, tokens = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    kinds, tokens = kinds + (texts > 0), tokens + texts

    runs = counts.filter("not is_word").select("key", "n")
    lengths = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("o")
    context = F.expr(f"substring(key, {ORDER} + 1 - o, o)")
    number = F.shiftleft(F.col("o").cast("long"), 8 * ORDER) + F.coalesce(F.conv(F.hex(context), 16, 10).cast("long"), F.lit(0))
    symbol = F.conv(F.hex(F.substring("key", ORDER + 1, 1)), 16, 10).cast("int")
    nodes = runs.select("key", "n", lengths).groupBy(number.alias("context"), symbol.alias("symbol")).agg(F.sum("n").alias("n"))
    nodes = materialise(spark, nodes, "trie")
    contexts = materialise(spark, _contexts(nodes), "contexts")
    seen = contexts.filter(F.col("context") >= ORDER << 8 * ORDER).select("context", "total", F.explode("seen").alias("symbol", "n"))
    run = F.expr(f"shiftleft(context & {(1 << 8 * ORDER) - 1}, 8) | symbol")
    seen = seen.select(run.alias("run"), "n", F.log10((F.col("n") - 0.5) / F.col("total")).alias("_v"))
    most = seen.filter(F.col("n") >= _least(seen, frequent_runs)).toArrow()
    order = np.argsort(-most["n"].to_numpy(), kind="stable")
    held = most["run"].to_numpy().astype(np.uint64)[order], most["_v"].to_numpy()[order]
    del most

    bound = _least(words, head)
    frequent = {bytes(w): math.log10(n + 1) for w, n in words.filter(F.col("n") >= bound).toLocalIterator()}
    shared = spark.sparkContext.broadcast(Scorer(*held, frequent))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("binary").alias("_text")).mapInArrow(
        lambda it: _score(it, shared.value), f"_uid long, _word binary, _n long, _doc {kind}, n_tokens long, _known long, _base double, score double"
    )
    rows = materialise(spark, rows, "rows")
    is_run = F.substring("_word", 1, 1) == F.lit(bytes([END]))
    key = F.concat(F.lit(bytes([END])), F.unhex(F.lpad(F.hex("run"), 2 * ORDER + 2, "0")))
    coded = seen.select(key.alias("_word"), "_v")
    unseen = rows.filter(is_run).select("_word").distinct().join(coded, "_word", "left_anti")
    rare = words.filter(F.col("n") < bound).select("_word", F.log10(F.col("n") + 1).alias("_v"))
    joined = rows.join(rare.unionByName(coded).unionByName(_unseen_codes(unseen, contexts)), "_word", "left")
    summed = joined.withColumn("_run", is_run).groupBy("_uid").agg(
        F.max("_doc").alias(id_col),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("_known") + F.coalesce(F.sum(F.when(~F.col("_run") & F.col("_v").isNotNull(), F.col("_n"))), F.lit(0)) + F.lit(int(texts > 0))).alias("n_known"),
        (F.max("_base") + F.coalesce(F.sum(F.when(~F.col("_run"), F.col("_n") * F.col("_v"))), F.lit(0.0)) + F.lit(math.log10(texts + 1))).alias("_base"),
        (F.max("score") + F.coalesce(F.sum(F.when(F.col("_run"), F.col("_n") * F.col("_v"))), F.lit(0.0))).alias("score"),
    )
    base = F.col("_base") - F.col("n_tokens") * F.lit(math.log10(tokens + kinds + 1))
    return summed.select(id_col, "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
