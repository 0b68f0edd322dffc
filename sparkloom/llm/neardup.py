"""MinHash near-dedup: fast similarity sketching, banding, exact verification, components."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, hot_join, in_slices, materialise, small_batches

#: Coordinates of a sketch and bands of BINS / BANDS coordinates. At a similarity of 0.8 a pair shares no band with
#: a chance of (1 - 0.8 ** 8) ** 64, less than 1 in 100,000.
BINS, BANDS = 512, 64
#: Sets and shingles in all that a block of a candidate cluster holds, about; two blocks meet in one task. Clusters
#: of more than WHOLE blocks are not compared all with all.
BLOCK_SETS, BLOCK_SHINGLES, WHOLE = 512, 400_000, 16
#: Ids of candidates that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle of all its words.

    Shingles are told apart by hashes of 64 bits of their words: within a document, or between two, the chance
    that two different ones agree is below 1 in 10 ** 12 for a million shingles.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    n = len(h) - width + 1
    key = np.full(n, np.uint64(width))
    for k in range(width):
        key = _mix(key + h[k : k + n])
    return np.unique(key)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Fast similarity sketches, a row of BINS coordinates for each set; rows of empty sets stay unfilled.

    Round i < BINS throws every element into one hashed bin with a value in [i, i + 1); round BINS + j throws all
    into bin j. A bin keeps its least value, and a set is done after the round that fills its last bin: at the
    latest after 2 BINS rounds, and after about one where it has many more elements than bins.
    """
    flat_size = len(sets) * BINS
    out, empty = np.full(flat_size, _EMPTY), np.full(len(sets), BINS)
    if not sets:
        return out.reshape(0, BINS)
    items, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * BINS):
        if not len(items):
            break
        h = _mix(items + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = doc * BINS + ((h & np.uint64(BINS - 1)).astype(np.int64) if i < BINS else i - BINS)
        fresh = out[place] == _EMPTY  # values of a later round never win
        place, value = place[fresh], (h[fresh] >> np.uint64(10)) | np.uint64(i << 54)
        np.minimum.at(out, place, value)
        empty -= np.bincount(np.unique(place) // BINS, minlength=len(sets))
        going = empty[doc] > 0
        if not going.all():
            items, doc = items[going], doc[going]
    return out.reshape(len(sets), BINS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for each band of each row; the band's number is part of it."""
    rows = sketch.reshape(len(sketch), BANDS, BINS // BANDS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for j in range(rows.shape[2]):
        key = _mix(key * _A + rows[:, :, j])
    return key


def _sign(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 500):
        sets = [shingles(t, width) for t in batch.column(batch.num_columns - 1).to_pylist()]
        keys = band_keys(sketches(sets)).view(np.int64)
        full = [len(s) > 0 for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if f else None for s, f in zip(sets, full, strict=True)], pa.binary()),
                pa.array([k if f else None for k, f in zip(keys, full, strict=True)], pa.list_(pa.int64())),
            ],
            names=[*batch.schema.names[:-1], "n_shingles", "_set", "_bands"],
        )


def _sets(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 500):
        sets = [s for s in (shingles(t, width) for t in batch.column(0).to_pylist()) if len(s)]
        yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["_set", "_items"])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other, as products of 0/1 matrices."""
    out = np.zeros((len(left), len(right)), np.float32)
    items = np.concatenate([*left, *right])
    own, number, n = np.unique(items, return_inverse=True, return_counts=True)
    # An element of one set alone is in no intersection.
    rank = np.cumsum(n > 1) - 1
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    shared = n[number] > 1
    row, col = row[shared], rank[number[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for at in range(0, int((n > 1).sum()), 8192):
        low, high = np.searchsorted(col, [at, at + 8192])
        dense = np.zeros((len(left) + len(right), 8192), np.float32)
        dense[row[low:high], col[low:high] - at] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out.astype(np.int64)


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, of full sets."""
    both = common_counts(left, right)
    sizes = np.add.outer([len(s) for s in left], [len(s) for s in right])
    return (both > 0) & (100 * both >= percent * (sizes - both))


def _forest(link: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Pairs of nodes that connect what the links connect, fewer than there are nodes."""
    out, free_left, free_right = [], np.ones(len(left), bool), np.ones(len(right), bool)
    for start in range(len(left)):
        if not free_left[start]:
            continue
        free_left[start] = False
        front = np.array([start])
        while len(front):
            near = np.flatnonzero(link[front].any(axis=0) & free_right)
            free_right[near] = False
            out += [(left[start], right[x]) for x in near.tolist()]
            front = np.flatnonzero(link[:, near].any(axis=1) & free_left) if len(near) else near
            free_left[front] = False
            out += [(left[start], left[x]) for x in front.tolist()]
    return [(a, b) for a, b in out if a != b]


def _verify(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Exact links within each (cluster, block, block) run of sorted rows: of the sets of side 0 with those of side 1,
    or among those of side 0 where there is no other."""

    def found(sides: tuple[dict[int, bytes], dict[int, bytes]]) -> list[tuple[int, int]]:
        a, b = ({c: np.frombuffer(s, np.uint64) for c, s in x.items()} for x in sides)
        b = b or a
        return _forest(linked(list(a.values()), list(b.values()), percent), list(a), list(b)) if a and len(a | b) > 1 else []

    now, sides, out = None, ({}, {}), []
    for batch in batches:
        for *key, side, cid, items in zip(*(batch.column(c).to_pylist() for c in ("_clu", "_i", "_k", "_side", "cid", "_items")), strict=True):
            if key != now:
                out += found(sides)
                now, sides = key, ({}, {})
            sides[side][cid] = items
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], names=["a", "b"])
            out = []
    out = found(sides)
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], names=["a", "b"])


def _links(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of rows (_clu, _i, _k, _side, cid, _set): all of a run meet in one task."""
    rows = met.join(sets, "_set").select("_clu", "_i", "_k", "_side", "cid", "_items")
    dealt = rows.repartition("_clu", "_i", "_k").sortWithinPartitions("_clu", "_i", "_k", "cid")
    return dealt.mapInArrow(lambda it: _verify(it, percent), "a long, b long")


def _blocks(n: Column, shingles: Column) -> Column:
    """Blocks of so many sets with so many shingles in all."""
    return F.greatest(F.ceil(n / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _verified(spark: SparkSession, members: DataFrame, bands: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the components of exact links among members (cid, _set, _size, _clu).

    Clusters of up to WHOLE blocks compare all blocks with all. A larger one compares all its sets with one block
    of them; then what shares a band, unless these links have already put it together: in each band's bucket the
    sets outside the bucket's largest component so far meet all of the bucket. So a large group of near copies
    costs a few comparisons with a block for each set, and a chain of chance collisions those of its small buckets.
    """
    sizes = members.groupBy("_clu").agg(F.count("*").alias("_m"), _blocks(F.count("*"), F.sum("_size")).alias("_blocks"))
    sizes = materialise(spark, sizes, "sizes")
    dealt = hot_join(members.select("cid", "_set", "_clu"), sizes, "_clu", "_m", members.count())
    dealt = dealt.withColumn("_blk", F.pmod(F.xxhash64("cid"), F.col("_blocks")).cast("int"))
    last = F.when((F.col("_blocks") > WHOLE) & (F.col("_blk") > 0), 0).otherwise(F.col("_blocks") - 1)
    rows = dealt.withColumn("_j", F.explode(F.sequence(F.lit(0), last)))
    met = rows.select("_clu", F.least("_blk", "_j").alias("_i"), F.greatest("_blk", "_j").alias("_k"), F.when(F.col("_blk") <= F.col("_j"), 0).otherwise(1).alias("_side"), "cid", "_set")
    links = materialise(spark, _links(met, sets, percent), "links")
    labels = components(spark, links)
    large = sizes.filter(F.col("_blocks") > WHOLE).select("_clu")
    if large.isEmpty():
        return labels

    # _clu is a band from here on; the bands of the large clusters' members only.
    within = members.join(large, "_clu", "left_semi").select("cid", "_set", "_size")
    within = within.join(labels, F.col("cid") == labels.node, "left").select("cid", "_set", "_size", F.coalesce("label", "cid").alias("_label"))
    within = materialise(spark, bands.withColumnRenamed("_band", "_clu").join(within, "cid").select("_clu", "cid", "_set", "_size", "_label"), "within")
    parts = within.groupBy("_clu", "_label").agg(F.count("*").alias("_n"), F.sum("_size").alias("_s"))
    one = F.max(F.struct("_n", "_label"))["_label"].alias("_main")
    groups = parts.groupBy("_clu").agg(F.sum("_n").alias("_m"), one, _blocks(F.sum("_n"), F.sum("_s")).alias("_blocks"), F.count("*").alias("_kinds")).filter("_kinds > 1")
    split = hot_join(within, groups, "_clu", "_m", within.count()).filter("_main is not null")
    split = materialise(spark, split.withColumn("_blk", F.pmod(F.xxhash64("cid"), F.col("_blocks")).cast("int")), "split")
    others = split.filter("_label <> _main")
    apart = others.groupBy("_clu").agg(F.count("*").alias("_m"), _blocks(F.count("*"), F.sum("_size")).alias("_rows"))
    left = hot_join(others, apart.withColumnRenamed("_m", "_o"), "_clu", "_o", others.count())
    left = left.withColumn("_i", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("_rows")).cast("int")).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    right = hot_join(split.drop("_m"), apart.join(groups.select("_clu", F.col("_m").alias("_all")), "_clu").select("_clu", "_rows", "_all"), "_clu", "_all", split.count())
    right = right.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1))).withColumn("_k", F.col("_blk"))
    names = ["_clu", "_i", "_k", "_side", "cid", "_set"]
    met = left.withColumn("_side", F.lit(0)).select(*names).unionByName(right.withColumn("_side", F.lit(1)).select(*names))
    return components(spark, links.unionByName(materialise(spark, _links(met, sets, percent), "links")))


def near_dedup(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of docs: id, columns keep, n_shingles, component_id, kept, component.

    Documents with equal shingle sets are one class, pre-aggregated before anything else, so copies cost one row
    each. Classes that share a band of their sketches are candidates; clusters of candidates are the components of
    the graph that joins each band's classes with the smallest of them. Every cluster is dealt into blocks of
    about BLOCK_SETS sets, and each pair of blocks meets in one task, which counts all intersections of full sets
    by matrix products and returns links as a forest: pairs are never rows. component_id is the smallest id that
    can be reached over links; kept is whether it is the row's own.

    Null, empty and blank texts have no shingles and are linked with nothing. Null ids are no smallest id unless
    all are null. Repeated rows keep a row each (both kept, if theirs is the smallest id); `component` tells
    groups apart even so, and is null without shingles. An empty table gives an empty one. Columns that are not
    named are not read. Shingles are told apart by 64-bit hashes, classes by 128-bit ones.
    """
    small_batches(spark)
    cols = [id_col, *keep]
    source = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], F.col(text_col).cast("binary").alias("_text"))
    kinds = ", ".join(f"`_k{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(cols))
    signed = materialise(spark, source.mapInArrow(lambda it: _sign(it, width), f"{kinds}, n_shingles long, _set binary, _bands array<long>"), "signatures")
    classes = signed.filter("_set is not null").groupBy("_set").agg(F.min("_k0").alias("_rep"), F.count("*").alias("_n"), F.first("n_shingles").alias("_size"), F.first("_bands").alias("_bands"))
    classes = materialise(spark, classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    bands = classes.select("cid", F.explode("_bands").alias("_band"))
    hub = F.first("cid").over(Window.partitionBy("_band").orderBy("cid").rowsBetween(Window.unboundedPreceding, 0))
    # A member keeps the edge to its smallest hub; its other hubs, at most one a band, are tied to that hub instead.
    tied = bands.select(hub.alias("hub"), "cid").filter("hub <> cid").groupBy("cid").agg(F.collect_set("hub").alias("_hubs"))
    tied = materialise(spark, tied.withColumn("_first", F.array_min("_hubs")), "hubs")
    among = tied.select(F.col("_first").alias("a"), F.explode("_hubs").alias("b")).distinct()
    clusters = components(spark, tied.select(F.col("_first").alias("a"), F.col("cid").alias("b")).unionByName(among))
    members = clusters.join(classes.select("cid", "_set", "_rep", "_size"), clusters.node == F.col("cid")).select("cid", "_set", "_rep", "_size", F.col("label").alias("_clu"))
    members = materialise(spark, members, "members")
    ids = members.select("_rep").distinct()
    few = members.count() <= BROADCAST_IDS
    texts = source.join(F.broadcast(ids) if few else ids, F.col("_k0").eqNullSafe(F.col("_rep")), "left_semi")
    sets = texts.select("_text").mapInArrow(lambda it: _sets(it, width), "_set binary, _items binary").groupBy("_set").agg(F.first("_items").alias("_items"))
    labels = _verified(spark, members, bands, sets, percent)

    labelled = classes.select("_set", "_rep", "_n", "cid").join(labels, F.col("cid") == labels.node, "left").select("_set", "_rep", "_n", F.coalesce("label", "cid").alias("component"))
    labelled = materialise(spark, labelled, "labelled")
    smallest = labelled.groupBy("component").agg(F.min("_rep").alias("component_id"), F.count("*").alias("_m"))
    ends = hot_join(labelled, smallest, "component", "_m", labelled.count()).select("_set", "_n", "component", "component_id")
    full = hot_join(signed.filter("_set is not null").drop("_bands"), ends, "_set", "_n", signed.count())
    none = signed.filter("_set is null").withColumn("component", F.lit(None).cast("long")).withColumn("component_id", F.col("_k0"))
    fields = [*[F.col(f"_k{i}").alias(c) for i, c in enumerate(cols)], "n_shingles", "component_id", F.col("_k0").eqNullSafe(F.col("component_id")).alias("kept"), "component"]
    return full.select(*fields).unionByName(none.select(*fields))
