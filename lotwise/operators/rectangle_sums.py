"""Sums over the points in each of many rectangles, without their pairs.

Both axes are cut at quantiles of the points into open strips and, between them, the cuts themselves, so a value that many
points share is a strip of its own. A rectangle is the whole strips that it covers on both axes (its core), the parts of
the strips at its left and right edge, and of its strips at the lower and upper edge what lies in whole strips of x.
The core is made of few blocks of powers of two of strips, whose sums are joined. A part meets the points of its strip in
one task. So work grows with points and rectangles, and not with their product; a strip grows with the points.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Open strips of an axis at most, and points that are worth one.
STRIPS, WORTH = 512, 1 << 16
#: Pieces that are compared with a block of points at once.
AT_ONCE = 2048
SUMS = {"number": F.sum, "low": F.min, "total": F.sum, "known": F.sum}


def cuts_of(points: DataFrame, x: str, y: str, strips: int) -> list[list[float]]:
    """Values that cut each axis into at most so many parts of about as many points, fewer for few points."""
    at = [k / strips for k in range(1, strips)]
    n, *rows = points.agg(F.count("*"), *(F.percentile_approx(F.col(c).cast("double"), at, 10_000) for c in (x, y))).first()
    step = max(1, strips // (n // WORTH + 1))
    return [sorted({v + 0.0 for v in (found or ())[step - 1 :: step] if abs(v) < float("inf")}) or [0.0] for found in rows]


def with_strips(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Adds, for each column with its cuts, the number of its strip: even between cuts, odd on a cut."""
    splits = []
    for values in cuts.values():
        own = [float("-inf")]
        for v in values:
            if own[-1] < v < 1e308:  # not the very next number after a cut, nor one without a next
                own += [v, math.nextafter(v, math.inf)]
        splits.append([*own, float("inf")])
    df = Bucketizer(splitsArray=splits, inputCols=list(cuts), outputCols=[f"{c}_strip" for c in cuts], handleInvalid="keep").transform(df)
    return df.withColumns({f"{c}_strip": F.col(f"{c}_strip").cast("int") for c in cuts})


def _block(level: Column, number: Column) -> Column:
    return level * F.lit(1 << 20) + number


def blocks_of(low: Column, high: Column, levels: int) -> Column:
    """The fewest blocks of powers of two of strips that make up low to high."""

    def ends(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level)
        first, past = F.ceil(low / size).cast("int"), F.floor((high + 1) / size).cast("int")
        return F.array(F.when((first < past) & (first % 2 == 1), _block(level, first)), F.when((first < past) & (past % 2 == 1), _block(level, past - 1)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), ends)))


def every_block(strip: Column, levels: int) -> Column:
    """The blocks of all levels that a strip lies in."""
    return F.array(*(_block(F.lit(k), F.shiftright(strip, k)) for k in range(levels + 1)))


def meet(points: pa.Table, pieces: pa.Table) -> pa.Table:
    """Sums over the points of a strip with u and v in each piece's bounds.

    Points are sorted by u and cut into about as many blocks as a block has points. A piece is compared one by one with the
    points of the blocks at its ends; in those between, sorted by v, its points are one run with sums and minima at hand.
    """
    by_u = np.argsort(points["u"].to_numpy())
    u, v, low, number, total, known = (points[c].to_numpy()[by_u] for c in ("u", "v", "low", "number", "total", "known"))
    first_u, last_u, first_v, last_v = (pieces[c].to_numpy() for c in ("first_u", "last_u", "first_v", "last_v"))
    if np.abs(total.astype(float)).sum() >= 2.0**62:
        total = total.astype(object)  # sums that may not fit until they are subtracted
    begin, end = np.searchsorted(u, first_u, "left"), np.searchsorted(u, last_u, "right")
    sums = [np.zeros(len(begin), column.dtype) for column in (number, total, known)]
    least = np.full(len(begin), np.inf)
    length = 1 << (len(u).bit_length() + 1) // 2
    first, last, some = begin // length, (end - 1) // length, begin < end
    for k, at in enumerate(range(0, len(u), length)):
        block = slice(at, at + length)
        block_v, block_low, columns = v[block], low[block], [c[block] for c in (number, total, known)]
        place = np.arange(at, at + len(block_v))
        edge = np.flatnonzero(some & ((first == k) | (last == k)))
        for e in (edge[i : i + AT_ONCE] for i in range(0, len(edge), AT_ONCE)):
            inside = (place >= begin[e, None]) & (place < end[e, None]) & (block_v >= first_v[e, None]) & (block_v <= last_v[e, None])
            for out, column in zip(sums, columns):
                out[e] += np.where(inside, column, 0).sum(axis=1)
            least[e] = np.minimum(least[e], np.where(inside, block_low, np.inf).min(axis=1))
        inner = np.flatnonzero(some & (first < k) & (k < last))
        if len(inner):
            order = np.argsort(block_v)
            i, j = np.searchsorted(block_v, first_v[inner], "left", order), np.searchsorted(block_v, last_v[inner], "right", order)
            inner, i, j = inner[i < j], i[i < j], j[i < j]
            for out, column in zip(sums, columns):
                running = np.concatenate([np.zeros(1, column.dtype), np.cumsum(column[order])])
                out[inner] += running[j] - running[i]
            minima = [block_low[order]]  # of runs of 1, 2, 4, ... points
            while 2 ** len(minima) <= len(order):
                half = 2 ** (len(minima) - 1)
                minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
            table = np.full((len(minima), len(order)), np.inf)
            for row, m in zip(table, minima):
                row[: len(m)] = m
            level = np.frexp((j - i).astype(float))[1] - 1
            least[inner] = np.minimum(least[inner], np.minimum(table[level, i], table[level, j - (1 << level)]))
    found = pa.array(sums[0] > 0)
    made = {"key": pieces["key"], "number": pa.array(sums[0], pa.int64()), "low": pa.array(least), "total": pa.array(sums[1], pa.int64()), "known": pa.array(sums[2], pa.int64())}
    return pa.table(made).filter(found)


def sums_in_rectangles(points: DataFrame, rectangles: DataFrame, key: str, x: str, y: str, value: str, strips: int = STRIPS) -> DataFrame:
    """key, number, low, total: how many points a key's rectangles (max_x, max_y, min_x, min_y) hold, edges included, their least x and the sum of a whole-numbered value.

    total is null where no value is known. Keys without points are left out. Null and NaN coordinates or bounds and empty
    rectangles hold nothing; rectangles that share a key add up. Equal points are one weighted row.
    """
    points = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double")))
    x_cuts, y_cuts = cuts_of(points, x, y, strips)
    places = points.groupBy(x, y).agg(F.count("*").alias("number"), F.sum(value).cast("long").alias("total"))
    # Adding 0 makes -0 and 0 one value for the search among cuts too.
    places = places.select((F.col(x).cast("double") + 0.0).alias("x"), (F.col(y).cast("double") + 0.0).alias("y"), "number", F.coalesce("total", F.lit(0).cast("long")).alias("total"), F.col("total").isNotNull().cast("long").alias("known"))
    places = with_strips(places, {"x": x_cuts, "y": y_cuts})

    bounds = {c: F.col(c).cast("double") + 0.0 for c in ("min_x", "max_x", "min_y", "max_y")}
    boxes = rectangles.select(F.col(key).alias("key"), *(v.alias(c) for c, v in bounds.items()))
    boxes = boxes.where("min_x <= max_x AND min_y <= max_y AND NOT (isnan(min_x) OR isnan(max_x) OR isnan(min_y) OR isnan(max_y))")
    boxes = with_strips(boxes, {"min_x": x_cuts, "max_x": x_cuts, "min_y": y_cuts, "max_y": y_cuts})
    whole = {f"first_{a}": F.expr(f"IF(min_{a}_strip % 2 = 1, min_{a}_strip, min_{a}_strip + 1)") for a in "xy"} | {f"last_{a}": F.expr(f"IF(max_{a}_strip % 2 = 1, max_{a}_strip, max_{a}_strip - 1)") for a in "xy"}
    boxes = boxes.withColumns(whole)

    x_levels, y_levels = ((2 * len(c)).bit_length() for c in (x_cuts, y_cuts))
    cells = places.groupBy("x_strip", "y_strip").agg(*(f(F.col("x") if c == "low" else F.col(c)).alias(c) for c, f in SUMS.items()))
    blocks = cells.withColumn("x_block", F.explode(every_block(F.col("x_strip"), x_levels))).withColumn("y_block", F.explode(every_block(F.col("y_strip"), y_levels)))
    blocks = blocks.groupBy("x_block", "y_block").agg(*(f(c).alias(c) for c, f in SUMS.items()))
    cores = boxes.where("first_x <= last_x AND first_y <= last_y")
    cores = cores.select("key", "first_y", "last_y", F.explode(blocks_of(F.col("first_x"), F.col("last_x"), x_levels)).alias("x_block"))
    cores = cores.select("key", "x_block", F.explode(blocks_of(F.col("first_y"), F.col("last_y"), y_levels)).alias("y_block"))
    # Merged: both sides are many times the size that Spark takes them for, after two explodes.
    core = cores.join(blocks.hint("merge"), ["x_block", "y_block"]).select("key", *SUMS)

    side = {"x": "", "y": "-1 -"}  # strips of both axes in one numbering

    def piece(axis: str, edge: str) -> Column:
        v = ("min_y", "max_y") if axis == "x" else ("CAST(first_x AS DOUBLE)", "CAST(last_x AS DOUBLE)")
        there = f"{edge}_{axis}_strip % 2 = 0" + (f" AND min_{axis}_strip <> max_{axis}_strip" if edge == "max" else "") + (" AND first_x <= last_x" if axis == "y" else "")
        return F.expr(f"IF({there}, named_struct('strip', {side[axis]} {edge}_{axis}_strip, 'first_u', min_{axis}, 'last_u', max_{axis}, 'first_v', {v[0]}, 'last_v', {v[1]}), NULL)")

    pieces = boxes.select("key", F.explode(F.array_compact(F.array(*(piece(a, e) for a in "xy" for e in ("min", "max"))))).alias("p")).select("key", "p.*")
    of_axes = [F.expr(f"IF({a}_strip % 2 = 0, named_struct('strip', {side[a]} {a}_strip, 'u', {a}, 'v', {v}), NULL)") for a, v in (("x", "y"), ("y", "CAST(x_strip AS DOUBLE)"))]
    dealt = places.select(F.col("x").alias("low"), "number", "total", "known", F.explode(F.array_compact(F.array(*of_axes))).alias("p")).select("p.*", "low", "number", "total", "known")
    kind = rectangles.schema[key].dataType.simpleString()
    edges = dealt.groupBy("strip").cogroup(pieces.groupBy("strip")).applyInArrow(meet, f"key {kind}, number long, low double, total long, known long")
    out = core.unionByName(edges).groupBy("key").agg(*(f(c).alias(c) for c, f in SUMS.items()))
    return out.select(F.col("key").alias(key), "number", "low", F.when(F.col("known") > 0, F.col("total")).alias("total"))
