"""Packing tokenised documents into windows by best-fit decreasing.

Documents longer than a window are first cut into full windows; what is left of
each document is placed, longest first, into the open window with the least room
that still holds it. A segment tree over the remaining capacities finds it.
Remainders are dealt by hash into groups of about GROUP_PIECES, each packed by
itself, so no task sees more than one group. Equal remainders are counted and their
copies numbered, so that they too are dealt over all groups.

Every input row is packed, repeated ids included. A null text is empty: its only
id is the end id. A very long text is a row per window. Remainders of one length are
placed by id (null first), start and checksum; of windows with the same room the one
that got it last is taken. Reruns give the same windows. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import cut

WINDOW = 4096
#: Remainders packed together; a group leaves about one window part-filled.
GROUP_PIECES = 4096
#: Texts tokenised together.
BATCH_ROWS = 500
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bin_group long, bin long, offset long"


class OpenWindows:
    """Segment tree over remaining capacities 0..capacity; a leaf holds the open windows with that much room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += by
            at >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least room of at least need among open windows, or None."""
        at = need + self.size
        if self.tree[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.windows[room].pop()


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length; lengths must be given in decreasing order and fit a window."""
    tree, opened, bins, offsets = OpenWindows(capacity), 0, [], []
    for need in lengths:
        room = tree.tightest(need)
        if room is None:
            window, room, opened = opened, capacity, opened + 1
        else:
            window = tree.take(room)
        bins.append(window)
        offsets.append(capacity - room)
        if room > need:
            tree.put(room - need, window)
    return bins, offsets


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: whole windows of long documents, then the remainder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = tokens.word_ids(tokenizer_path), np.array([tokens.END], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                rows = []
                ids, starts = words.encode(b.column("text"))
                for doc_id, first, last in zip(b.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    own = ids[first:last].tobytes() + end
                    n = last - first + 1
                    for start in range(0, n, window):
                        part = own[4 * start : 4 * (start + window)]
                        rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], COLUMNS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset; sequence ids are unique, offsets gapless from 0."""
    found = cut(cut_pieces(docs, tokenizer_path, window), "pieces")
    groups = max(1, -(-found.where(F.col("length") < window).count() // group_pieces))

    def place(t: pa.Table) -> pa.Table:
        order = sorted(range(t.num_rows), key=list(zip(*([-x for x in t.column("length").to_pylist()], *([(x is not None, x or 0) for x in t.column(c).to_pylist()] for c in ("doc_id", "start", "ids_crc32"))), strict=True)).__getitem__)
        t = t.take(pa.array(order, pa.int64()))
        bins, offsets = best_fit(t.column("length").to_pylist(), window)
        return t.append_column("bin", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    # Equal remainders are interchangeable: counted where they lie, then dealt one by one.
    equal = found.where(F.col("length") < window).groupBy(*COLUMNS).agg(F.count("*").alias("n"))
    each = equal.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    group = F.pmod(F.xxhash64(*COLUMNS, "copy"), F.lit(groups)).alias("bin_group")
    rest = each.select(*COLUMNS, group).groupBy("bin_group").applyInArrow(place, PACKED).withColumn("sequence_id", F.shiftleft(F.col("bin_group"), 32) + F.col("bin"))
    # A whole window is a sequence of its own; the pieces lie written, so their running ids are fixed.
    full = found.where(F.col("length") == window).withColumn("sequence_id", F.lit(1 << 61) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    out = [*COLUMNS, "sequence_id", "offset"]
    return rest.select(*out).unionByName(full.select(*out))
