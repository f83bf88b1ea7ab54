"""Map rectangles: parsing, grids, point counts, adaptive splitting, page plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

MAX_DEPTH = 24
# Listings a cell may hold and listings of a page, by source; pages of a cell.
CELL_CAPS = {"vivareal": 600, "quintoandar": 1000, "zapimoveis": 1000}
PAGE_SIZES = {"vivareal": 30, "quintoandar": 250, "zapimoveis": 30}
MAX_PAGES = 50
BOUNDS = ["max_x", "max_y", "min_x", "min_y"]


def parse_rectangle(text: Column) -> Column:
    """struct(max_x, max_y, min_x, min_y) of four numbers split by comma, semicolon or bar; else null."""
    parts = F.transform(F.split(text, "[,;|]"), lambda p: F.trim(p).try_cast("double"))
    good = (F.size(parts) == 4) & F.forall(parts, lambda p: p.isNotNull())
    return F.when(good, F.struct(*(F.get(parts, F.lit(k)).alias(b) for k, b in enumerate(BOUNDS))))


def render_rectangle(r: Column) -> Column:
    return F.concat(r["max_x"].cast("string"), F.lit(","), r["max_y"].cast("string"), F.lit("|"), r["min_x"].cast("string"), F.lit(","), r["min_y"].cast("string"))


def width(r: Column) -> Column:
    return r["max_x"] - r["min_x"]


def height(r: Column) -> Column:
    return r["max_y"] - r["min_y"]


def best_columns(n: Column, aspect: Column) -> Column:
    """The divisor nx of n for which nx / (n / nx) is nearest to the aspect, the smallest of equals; n without an aspect."""
    low = F.filter(F.sequence(F.lit(1).cast("bigint"), F.greatest(F.lit(1), F.floor(F.sqrt(n.cast("double")))).cast("bigint")), lambda i: n % i == 0)
    divisors = F.concat(low, F.transform(low, lambda i: F.floor(n / i)))
    best = F.array_min(F.transform(divisors, lambda i: F.struct(F.abs(i * i / n - aspect).alias("error"), i.alias("nx"))))
    return F.when(aspect.isNull(), n).otherwise(best["nx"])


def grid_shape(df: DataFrame, n: Column) -> DataFrame:
    """Adds nx, ny, dx, dy of a split of each row's bounds into ceil(n) cells; n below 1 gives nulls."""
    c = F.when(n >= 1, F.ceil(n).cast("bigint"))
    w, h = F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")
    df = df.withColumn("nx", best_columns(c, F.when(h > 0, w / h)))
    df = df.withColumn("ny", F.floor(c / F.col("nx")))
    return df.withColumns({"dx": (F.col("max_x") - F.col("min_x")) / F.col("nx"), "dy": (F.col("max_y") - F.col("min_y")) / F.col("ny")})


def cell_bounds(i: Column, j: Column) -> dict[str, Column]:
    """Bounds of cell (i, j) of a row with nx, ny, dx, dy; the last ones end at the outer edge."""
    return {
        "max_x": F.when(i < F.col("nx") - 1, F.col("min_x") + (i + 1) * F.col("dx")).otherwise(F.col("max_x")),
        "max_y": F.when(j < F.col("ny") - 1, F.col("min_y") + (j + 1) * F.col("dy")).otherwise(F.col("max_y")),
        "min_x": F.col("min_x") + i * F.col("dx"),
        "min_y": F.col("min_y") + j * F.col("dy"),
    }


def unsplittable(rectangles: DataFrame, n: Column) -> DataFrame:
    """Rectangles that cannot be split into n cells, with the reason why they are kept out."""
    return rectangles.where(F.coalesce(n < 1, F.lit(True))).withColumn("code", F.lit("fewer_than_one_cell"))


def split_grid(rectangles: DataFrame, n: Column) -> DataFrame:
    """The cells of each rectangle, column by column: other columns, i, j and the bounds. n below 1 has no cells: see unsplittable."""
    kept = [c for c in rectangles.columns if c not in BOUNDS]
    cells = grid_shape(rectangles, n).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nx") - 1)))
    cells = cells.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("ny") - 1)))
    return cells.select(*kept, "i", "j", *(v.alias(k) for k, v in cell_bounds(F.col("i"), F.col("j")).items()))


def cell_of(x: Column, low: Column, step: Column, n: Column) -> Column:
    """Index of the half-open cell that holds x; the outer edge belongs to the last one."""
    return F.when(step > 0, F.greatest(F.lit(0), F.least(n - 1, F.floor((x - low) / step)))).otherwise(F.lit(0)).cast("bigint")


def count_grid(points: DataFrame, bounds: dict[str, float], nx: int, ny: int) -> DataFrame:
    """Points per cell of a grid over the bounds, points outside left out: i, j, n."""
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    inside = points.where(x.between(bounds["min_x"], bounds["max_x"]) & y.between(bounds["min_y"], bounds["max_y"]))
    i = cell_of(x, F.lit(bounds["min_x"]), F.lit((bounds["max_x"] - bounds["min_x"]) / nx), F.lit(nx))
    j = cell_of(y, F.lit(bounds["min_y"]), F.lit((bounds["max_y"] - bounds["min_y"]) / ny), F.lit(ny))
    return inside.groupBy(i.alias("i"), j.alias("j")).agg(F.count("*").alias("n"))


def adaptive_cells(points: DataFrame, cap: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Splits the points' bounding box until no cell holds more than cap points or max_depth is reached.

    Gives cell (a path of cell numbers), depth, the bounds and n of every leaf that holds points. Equal points are counted
    first, so a hot place is one row with a weight from then on. Each level is one sum per cell; only places of cells that
    are still too full go on to the next.
    """
    points = points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    places = written(points.groupBy("x", "y").agg(F.count("*").alias("weight")), "places")
    box = places.agg(F.max("x").alias("max_x"), F.max("y").alias("max_y"), F.min("x").alias("min_x"), F.min("y").alias("min_y")).first()
    held = places.withColumns({"cell": F.lit("0"), **{b: F.lit(box[b]).cast("double") for b in BOUNDS}})
    leaves = None
    for depth in range(max_depth + 1):
        cells = written(held.groupBy("cell", *BOUNDS).agg(F.sum("weight").alias("n")), "cells").withColumn("depth", F.lit(depth))
        one_place = (F.col("max_x") <= F.col("min_x")) & (F.col("max_y") <= F.col("min_y"))
        full = (F.col("n") > cap) & ~one_place & (F.col("depth") < max_depth)
        done = cells.where(~full)
        leaves = done if leaves is None else leaves.unionByName(done)
        open_ = grid_shape(cells.where(full), F.col("n") / cap).select("cell", "nx", "ny", "dx", "dy")
        if open_.isEmpty():
            break
        rows = held.join(open_, "cell")
        i, j = cell_of(F.col("x"), F.col("min_x"), F.col("dx"), F.col("nx")), cell_of(F.col("y"), F.col("min_y"), F.col("dy"), F.col("ny"))
        rows = rows.withColumns({"i": i, "j": j})
        path = F.concat_ws(".", "cell", F.col("i") * F.col("ny") + F.col("j"))
        held = written(rows.select("x", "y", "weight", path.alias("cell"), *(v.alias(k) for k, v in cell_bounds(F.col("i"), F.col("j")).items())), "places")
    return leaves


#: Grids that points may be dealt to; with more in use, neighbouring ones share the coarser.
MAX_GRIDS = 64


def level_of(low: Column, high: Column) -> Column:
    """Exponent of the smallest power of two that is as long as a side; cell numbers stay below 2^51."""
    far = F.greatest(F.abs(low), F.abs(high))
    return F.greatest(F.ceil(F.log2(F.greatest(high - low, F.lit(1e-300)))), F.ceil(F.log2(F.greatest(far, F.lit(1e-290)))) - 50).cast("int")


def in_rectangles(points: DataFrame, rectangles: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Every pair of a point and a rectangle (max_x, max_y, min_x, min_y) that holds it, edges included, with all columns of both.

    A rectangle lies in the grid whose cells are as wide and as high as itself, rounded up to powers of two, so it covers at
    most four of them, however large or flat it is; a point lies in one cell of each grid in use. Both are joined by grid and
    cell and then compared. Each pair meets once. If more than MAX_GRIDS grids are in use, exponents are rounded up to
    multiples of 2, 4, ... until there are no more. Null coordinates and empty rectangles pair with nothing. Points in a hot
    cell are split by Spark's skew join.
    """
    b = {k: F.col(k).cast("double") for k in BOUNDS}
    boxes = rectangles.where((b["min_x"] <= b["max_x"]) & (b["min_y"] <= b["max_y"]))
    boxes = boxes.withColumns({"_lx": level_of(b["min_x"], b["max_x"]), "_ly": level_of(b["min_y"], b["max_y"])})
    used, step = {(r[0], r[1]) for r in boxes.select("_lx", "_ly").distinct().collect()}, 1

    def rounded(level: int, step: int) -> int:
        return -(-level // step) * step

    while len({(rounded(i, step), rounded(j, step)) for i, j in used}) > MAX_GRIDS:
        step *= 2
    grids = sorted({(rounded(i, step), rounded(j, step)) for i, j in used})
    boxes = boxes.withColumns({c: (F.ceil(F.col(c) / step) * step).cast("int") for c in ("_lx", "_ly")})

    def cell(value: Column, level: str) -> Column:
        return F.floor(value / F.pow(F.lit(2.0), F.col(level))).cast("bigint")

    def span(axis: str) -> Column:
        return F.explode(F.sequence(cell(b[f"min_{axis}"], f"_l{axis}"), cell(b[f"max_{axis}"], f"_l{axis}")))

    boxes = boxes.withColumn("_i", span("x")).withColumn("_j", span("y"))
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    each = F.array(*(F.struct(F.lit(i).alias("_lx"), F.lit(j).alias("_ly")) for i, j in grids)).cast("array<struct<_lx:int,_ly:int>>")
    places = points.where(px.isNotNull() & py.isNotNull()).withColumn("_grid", F.explode(each)).withColumns({"_lx": F.col("_grid._lx"), "_ly": F.col("_grid._ly")}).drop("_grid")
    places = places.withColumns({"_i": cell(px, "_lx"), "_j": cell(py, "_ly")})
    keys = ["_lx", "_ly", "_i", "_j"]
    return places.join(boxes, keys).where(px.between(b["min_x"], b["max_x"]) & py.between(b["min_y"], b["max_y"])).drop(*keys)


def page_plan(cells: DataFrame, size: int, n: str = "n", max_pages: int = MAX_PAGES) -> DataFrame:
    """One row per page of each cell: page from 1 and offset; one page at least, max_pages at most."""
    pages = F.least(F.greatest(F.lit(1), F.ceil(F.col(n) / size)), F.lit(max_pages)).cast("int")
    return cells.withColumn("page", F.explode(F.sequence(F.lit(1), pages))).withColumn("offset", (F.col("page") - 1) * size)


def planned_pages(cells: DataFrame, size: int, n: str = "n") -> DataFrame:
    return cells.agg(F.sum(F.ceil(F.col(n) / size)).alias("pages"))
