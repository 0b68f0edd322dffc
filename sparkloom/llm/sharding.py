"""Sharding by minimax contiguous partition of ordered atomic groups."""

import bisect
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hot_join, longs, materialise, numbered

#: Sums that the driver holds at once, about; and as many for each shard at least.
SKETCH, PER_SHARD = 60_000, 48


class Sums:
    """Some of the running sums of sizes in their order, the last one included, and whether others lie before each."""

    def __init__(self, known: list[int], whole: list[bool]) -> None:
        """whole[i]: no sum lies between known[i - 1] (or 0) and known[i]."""
        self.known, self.whole, self.total = known, whole, known[-1]

    def below(self, limit: int) -> tuple[int, int]:
        """Bounds of the largest sum that is not above limit; they agree where the sums around it are known."""
        at = bisect.bisect_right(self.known, limit)
        low = self.known[at - 1] if at else 0
        return low, low if at == len(self.known) or self.whole[at] else min(limit, self.known[at] - 1)

    def cuts(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of where each shard ends if it takes all that fits; a later start never ends earlier."""
        low = high = 0
        out = []
        for _ in range(shards):
            low, high = self.below(low + capacity)[0], self.below(high + capacity)[1]
            out.append((low, high))
        return out

    def smallest(self, shards: int, largest: int) -> tuple[int, int]:
        """Bounds of the smallest capacity that is enough, each by bisection."""
        out, least = [], max(largest, -(-self.total // shards))
        for side in (1, 0):
            low, high = least, -(-self.total // shards) + largest
            while low < high:
                tried = (low + high) // 2
                low, high = (low, tried) if self.cuts(tried, shards)[-1][side] >= self.total else (tried + 1, high)
            out.append(low)
        return out[0], out[1]


def _undecided(sums: Sums, nth: list[int], low: int, high: int, shards: int, most: int = 64) -> list[tuple[int, int]]:
    """Places among the known sums (above one, up to another) between which unknown ones may decide, at most so many.

    A shard may end anywhere between its lower bound for the smallest capacity and its upper one for the largest.
    """
    gaps: set[int] = set()
    for (a, _), (_, b) in zip(sums.cuts(low, shards), sums.cuts(high, shards), strict=True):
        gaps |= {g for g in range(bisect.bisect_right(sums.known, a), min(bisect.bisect_right(sums.known, b), len(nth) - 1) + 1) if not sums.whole[g]}
    order = sorted(gaps)
    apart = sorted(range(1, len(order)), key=lambda i: order[i] - order[i - 1])[1 - most :]
    breaks = [0, *sorted(i for i in apart if order[i] > order[i - 1] + 1), len(order)]
    return [(order[a] - 1, order[b - 1]) for a, b in zip(breaks, breaks[1:], strict=False)]


def smallest_cuts(prefix: DataFrame, shards: int, largest: int, groups: int, sketch: int = SKETCH) -> list[int]:
    """Where the shards end with the smallest capacity with which greedy filling needs at most so many of them.

    prefix has _sum, the running sums, and _nth, their number in the order. The driver bisects the capacity, each
    step checked greedily, over every step-th sum: this bounds the capacity, and where each shard may end. Only the
    sums there are read next, more densely, until all that decide are known: a few passes, each of which returns
    about `sketch` sums (or 48 for each shard) whatever the number of groups. If a pass decides little, as with some
    thousand shards, the next may return twice as many.
    """
    most, rows = max(sketch, PER_SHARD * shards), groups
    inside, known = F.lit(True), {}
    while True:
        step = -(-rows // most)
        known |= dict(tuple(r) for r in prefix.filter(inside & ((F.col("_nth") % step == 0) | (F.col("_nth") == groups - 1))).select("_nth", "_sum").collect())
        nth = sorted(known)
        sums = Sums([known[n] for n in nth], [b - a == 1 for a, b in zip([-1, *nth], nth, strict=False)])
        low, high = sums.smallest(shards, largest)
        cuts = sums.cuts(low, shards)
        if low == high and all(a == b for a, b in cuts):
            return [a for a, _ in cuts]
        windows = [(nth[a] if a >= 0 else -1, nth[b]) for a, b in _undecided(sums, nth, low, high, shards)]
        inside = reduce(or_, [(F.col("_nth") > a) & (F.col("_nth") < b) for a, b in windows])
        left = sum(b - a - 1 for a, b in windows)
        most, rows = most * (2 if 2 * left > rows else 1), left


def minimax_shards(spark: SparkSession, docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", sketch: int = SKETCH) -> DataFrame:
    """One row for each row of docs: id, size, text_crc32, shard, slot.

    Rows with equal texts are one atomic group; groups are ordered by their smallest id (null first), then by
    digest. Their sizes (UTF-8 bytes plus 1 of each row; null has no bytes and shares a group with the empty
    text) are summed over range partitions, the smallest feasible capacity is searched, and the order is cut
    there. slot numbers the rows of a shard from 0 without gaps, in group order, then by id.

    Groups are pre-aggregated; a group with 1/1000 of all rows or more is joined by a broadcast of at most
    1000 rows, so no task gets a hot group's rows. Repeated rows keep one slot each. An empty table gives an
    empty one; more shards than groups leave the last shards empty. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).alias("_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("_key"))
    base = materialise(spark, base, "sizes")
    groups = base.groupBy("_key").agg(F.sum("size").alias("_size"), F.count("*").alias("_n"), F.min("_id").alias("_gid"))
    groups = numbered(spark, groups, [F.col("_gid"), F.col("_key")], "groups")
    total = n_groups = n = largest = 0
    offsets = []
    for pid, s, k, rows, top in sorted(tuple(r) for r in groups.groupBy("_pid").agg(F.sum("_size"), F.count("*"), F.sum("_n"), F.max("_size")).collect()):
        offsets.append((pid, total, n_groups))
        total, n_groups, n, largest = total + s, n_groups + k, n + rows, max(largest, top)
    if not offsets:
        return base.select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    at = longs(spark, offsets, "_pid", "_before", "_first")
    running = F.sum("_size").over(Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    prefix = groups.join(F.broadcast(at), "_pid").select("_key", "_gid", "_n", (running + F.col("_before")).alias("_sum"), (F.col("_at") + F.col("_first")).alias("_nth"))
    prefix = materialise(spark, prefix, "prefix")
    cuts = smallest_cuts(prefix.select("_sum", "_nth"), shards, largest, n_groups, sketch)
    shard = F.expr(f"aggregate(array({', '.join(f'{c}L' for c in cuts[:-1])}), 0, (a, c) -> a + if(_sum > c, 1, 0))") if shards > 1 else F.lit(0)
    placed = hot_join(base, prefix.select("_key", "_gid", "_n", shard.cast("int").alias("shard")), "_key", "_n", n)
    rows = placed.select("_id", "size", "text_crc32", "shard", "_gid", "_key")
    rows = numbered(spark, rows, [F.col(c) for c in ("shard", "_gid", "_key", "_id")], "placed")
    taken: dict[int, int] = {}
    first = []
    for pid, s, n, low in sorted(tuple(r) for r in rows.groupBy("_pid", "shard").agg(F.count("*"), F.min("_at")).collect()):
        first.append((pid, s, taken.get(s, 0) - low))
        taken[s] = taken.get(s, 0) + n
    at = longs(spark, first, "_pid", "shard", "_first").withColumn("shard", F.col("shard").cast("int"))
    return rows.join(F.broadcast(at), ["_pid", "shard"]).select(F.col("_id").alias(id_col), "size", "text_crc32", "shard", (F.col("_at") + F.col("_first")).alias("slot"))
