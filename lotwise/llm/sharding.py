"""Shards of near-equal bytes: best-fit-decreasing packing of indivisible groups.

Rows with equal texts form a group, which is never divided. Best fit puts groups of one
size into one bin after the other for as long as they fit, so groups are packed as (size,
number of groups) and each gets its bin by its rank within its size. Only these pairs
leave the executors; there are fewer of them than the root of twice the bytes. A group
larger than an equal share gets a shard of its own and the other shards share what is
left.

A null text is empty, a very long one a large group. Groups of one size are ranked by the
digests of their texts. Repeated rows are kept, each with a slot of its own. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

OVERHEAD = 16
#: Rows that share a numbering task.
SLOT_ROWS = 20_000


class RoomTree:
    """Treap of (room, bin) pairs: the bin with the least room of at least a need, in logarithmic time."""

    def __init__(self):
        self.root = None

    def _split(self, node, key):
        """Trees of the keys below key and of the rest."""
        if node is None:
            return None, None
        k, rank, left, right = node
        if k < key:
            low, high = self._split(right, key)
            return (k, rank, left, low), high
        low, high = self._split(left, key)
        return low, (k, rank, high, right)

    def _join(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return low[0], low[1], low[2], self._join(low[3], high)
        return high[0], high[1], self._join(low, high[2]), high[3]

    def add(self, room: int, bin_: int) -> None:
        low, high = self._split(self.root, (room, bin_))
        self.root = self._join(self._join(low, ((room, bin_), crc32(b"%d:%d" % (room, bin_)), None, None)), high)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= need:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            low, rest = self._split(self.root, best)
            _, high = self._split(rest, (best[0], best[1] + 1))
            self.root = self._join(low, high)
        return best


Run = tuple[int, int, int]


def best_fit_decreasing(sizes: list[tuple[int, int]], bins: int, capacity: int) -> list[Run] | None:
    """Runs (size, number, bin) for pairs (size, number) in decreasing order, or None if more than so many bins would be needed."""
    tree, opened, out = RoomTree(), 0, []
    for size, number in sizes:
        while number:
            found = tree.take_tightest(size)
            if found is None:
                if opened == bins or size > capacity:
                    return None
                found, opened = (capacity, opened), opened + 1
            room, bin_ = found
            # What is left of the tightest bin is tighter still, so it takes the next of this size too.
            fit = min(number, room // size)
            out.append((size, fit, bin_))
            tree.add(room - fit * size, bin_)
            number -= fit
    return out


def plan(sizes: list[tuple[int, int]], bins: int) -> list[Run]:
    """Runs of (size, number) pairs in decreasing order at the least capacity, by doubling steps, at which best fit needs no more bins."""
    own, rest, total = [], list(sizes), sum(size * number for size, number in sizes)
    while rest and len(own) < bins - 1 and rest[0][0] * (bins - len(own)) > total:  # larger than an equal share of the rest
        size, number = rest[0]
        own.append((size, 1, len(own)))
        total -= size
        rest[:1] = [(size, number - 1)] if number > 1 else []
    left = bins - len(own)
    even = max([-(-total // left), *(size for size, _ in rest[:1])])
    for slack in (0, *(2**k for k in range(64))):
        if (found := best_fit_decreasing(rest, left, even + slack * max(1, even >> 16))) is not None:
            return own + [(size, number, len(own) + b) for size, number, b in found]
    raise AssertionError("unreachable: the capacity exceeds the total")


def shards(docs: DataFrame, bins: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"))
    groups = cut(rows.groupBy("digest", "size").agg(F.count("*").alias("n")).select("digest", "n", (F.col("size") * F.col("n")).alias("bytes")), "groups")
    found = groups.groupBy("bytes").agg(F.count("*").alias("groups"), F.sum("n").alias("rows")).toArrow()  # one row for each size of a group
    sizes = sorted(zip(found.column("bytes").to_pylist(), found.column("groups").to_pylist(), strict=True), reverse=True)
    runs, upto = [], 0
    for k, (size, number, bin_) in enumerate(placed := plan(sizes, bins)):
        upto = number if not k or placed[k - 1][0] != size else upto + number
        runs.append((size, upto, bin_))
    table = pa.table([pa.array(x, t) for x, t in zip(zip(*runs, strict=True) if runs else ((),) * 3, (pa.int64(), pa.int64(), pa.int32()), strict=True)], ["bytes", "upto", "bin"])
    by_size = docs.sparkSession.createDataFrame(table).groupBy("bytes").agg(F.array_sort(F.collect_list(F.struct("upto", "bin"))).alias("runs"))  # at most bins runs a size
    ranked = numbered(groups, "bytes", ["digest"], max(16, sum(n for _, n in sizes) // SLOT_ROWS)).withColumnRenamed("slot", "rank")
    own = F.get(F.filter("runs", lambda r: r["upto"] > F.col("rank")), F.lit(0))["bin"]
    shard = ranked.join(by_size, "bytes").select("digest", own.alias("shard"))
    out = rows.join(shard, "digest").select("doc_id", "size", "text_crc32", "shard")
    return numbered(out, "shard", ["doc_id", "text_crc32"], 8 * max(1, -(-(sum(found.column("rows").to_pylist())) // (bins * SLOT_ROWS))))


def numbered(rows: DataFrame, key: str, order: list[str], salts: int) -> DataFrame:
    """Adds slot, gapless from 0 within the key; a key is numbered by as many tasks as there are salts."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    before = Window.partitionBy(key).orderBy("salt")
    start = rows.groupBy(key, "salt").agg(F.count("*").alias("n")).select(key, "salt", (F.sum("n").over(before) - F.col("n")).alias("start"))
    within = F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order))
    return rows.withColumn("at", within).join(start, [key, "salt"]).select(*(c for c in rows.columns if c != "salt"), (F.col("start") + F.col("at") - 1).alias("slot"))
