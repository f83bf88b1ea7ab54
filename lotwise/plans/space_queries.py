"""Queries on map cells and page plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rectangle_sums, spatial
from .registry import query, read


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))


@query("""WITH p AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
SELECT CAST(least(2, floor((x + 0.5) / (1.0::DOUBLE / 3))) AS BIGINT) AS i, CAST(least(3, floor((y + 0.5) / 0.25::DOUBLE)) AS BIGINT) AS j, count(*) AS n
FROM p WHERE x BETWEEN -0.5 AND 0.5 AND y BETWEEN -0.5 AND 0.5 GROUP BY 1, 2""")
def f24_grid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.count_grid(_points(spark, sf_dir), {"min_x": -0.5, "max_x": 0.5, "min_y": -0.5, "max_y": 0.5}, 3, 4)


@query("""WITH RECURSIVE p AS (SELECT CAST(l_extendedprice AS DOUBLE) AS x, CAST(l_quantity AS DOUBLE) AS y, count(*) AS w FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL GROUP BY 1, 2),
box AS (SELECT max(x) AS x1, max(y) AS y1, min(x) AS x0, min(y) AS y0 FROM p),
l AS (
  SELECT '0' AS cell, 0 AS depth, x1, y1, x0, y0, x, y, w, sum(w) OVER () AS n FROM p, box
  UNION ALL
  SELECT cell, depth, x1, y1, x0, y0, x, y, w, sum(w) OVER (PARTITION BY cell) AS n FROM (
    SELECT cell || '.' || CAST(i * ny + j AS VARCHAR) AS cell, depth + 1 AS depth, CASE WHEN i < nx - 1 THEN x0 + (i + 1) * dx ELSE x1 END AS x1, CASE WHEN j < ny - 1 THEN y0 + (j + 1) * dy ELSE y1 END AS y1,
      x0 + i * dx AS x0, y0 + j * dy AS y0, x, y, w FROM (
      SELECT *, CASE WHEN dx > 0 THEN greatest(0, least(nx - 1, CAST(floor((x - x0) / dx) AS BIGINT))) ELSE 0 END AS i, CASE WHEN dy > 0 THEN greatest(0, least(ny - 1, CAST(floor((y - y0) / dy) AS BIGINT))) ELSE 0 END AS j FROM (
        SELECT *, (x1 - x0) / nx AS dx, (y1 - y0) / ny AS dy FROM (
          SELECT *, c // nx AS ny FROM (
            SELECT *, CASE WHEN y1 > y0 THEN list_min(list_transform(list_filter(range(1, c + 1), lambda k: c % k = 0), lambda k: {'e': abs((k * k) / c::DOUBLE - (x1 - x0) / (y1 - y0)), 'nx': k})).nx ELSE c END AS nx FROM (
              SELECT *, CAST(ceil(n / 1000.0) AS BIGINT) AS c FROM l WHERE n > 1000 AND depth < 24 AND NOT (x1 <= x0 AND y1 <= y0))))))))
SELECT cell, depth, x1 AS max_x, y1 AS max_y, x0 AS min_x, y0 AS min_y, CAST(any_value(n) AS BIGINT) AS n FROM l WHERE n <= 1000 OR depth = 24 OR (x1 <= x0 AND y1 <= y0) GROUP BY cell, depth, x1, y1, x0, y0""")
def f25_adaptive_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of at most 1,000 points of (extended price, quantity)."""
    points = read(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"))
    return spatial.adaptive_cells(points, spatial.CELL_CAPS["quintoandar"])


@query("""SELECT count(*) AS points, 1 AS all_in_cells FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL""")
def f25_cells_hold_all_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = f25_adaptive_cells(spark, sf_dir)
    good = (F.col("n") <= 1000) | (F.col("depth") == spatial.MAX_DEPTH) | ((F.col("max_x") <= F.col("min_x")) & (F.col("max_y") <= F.col("min_y")))
    return cells.agg(F.sum("n").alias("points"), F.min(good.cast("int")).alias("all_in_cells"))


@query("""WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), p AS (SELECT *, least(greatest(1, CAST(ceil(n / 30.0) AS INT)), 50) AS pages FROM c)
SELECT user_id, n, CAST(unnest(generate_series(1, pages)) AS INT) AS page, CAST((unnest(generate_series(1, pages)) - 1) * 30 AS INT) AS "offset" FROM p""")
def f26_page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return spatial.page_plan(counts, spatial.PAGE_SIZES["vivareal"])


@query("""SELECT CAST(sum(ceil(n / 250.0)) AS BIGINT) AS pages FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)""")
def f26_planned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = read(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return spatial.planned_pages(counts, spatial.PAGE_SIZES["quintoandar"])


@query("""WITH r AS (SELECT s_suppkey, CAST(s_nationkey + 10 AS DOUBLE) AS max_x, CAST(s_nationkey + 5 AS DOUBLE) AS max_y, CAST(s_nationkey AS DOUBLE) AS min_x, CAST(s_nationkey AS DOUBLE) AS min_y FROM supplier)
SELECT s_suppkey, max_x, max_y, min_x, min_y, 10.0::DOUBLE AS width, 5.0::DOUBLE AS height, (i + j * 0)::BIGINT AS i, j::BIGINT AS j, min_x + i * 2.5 AS cell_x, min_y + j * 2.5 AS cell_y
FROM r, (SELECT unnest([0, 1, 2, 3]) AS i), (SELECT unnest([0, 1]) AS j)""")
def f38_split_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles from texts, split into 8 cells each: 4 by 2 for a box of 10 by 5."""
    key = F.col("s_nationkey")
    text = F.concat_ws("|", F.concat_ws(",", (key + 10).cast("string"), (key + 5).cast("string")), F.concat_ws(", ", key.cast("string"), key.cast("string")))
    r = read(spark, sf_dir, "supplier").select("s_suppkey", spatial.parse_rectangle(text).alias("r"))
    boxes = r.select("s_suppkey", "r.*", F.struct("r.*").alias("box"))
    cells = spatial.split_grid(boxes, F.lit(7.2)).withColumnsRenamed({"min_x": "cell_x", "min_y": "cell_y"}).drop("max_x", "max_y")
    return cells.select("s_suppkey", "box.*", spatial.width(F.col("box")).alias("width"), spatial.height(F.col("box")).alias("height"), "i", "j", "cell_x", "cell_y")


@query("""WITH r AS (SELECT s_suppkey, CAST((s_suppkey * 7919) % 90000 AS DOUBLE) AS min_x, CAST((s_suppkey * 31) % 50 AS DOUBLE) AS min_y, power(2.0, (s_suppkey % 14)) AS w, power(2.0, (s_suppkey % 6)) / 4 AS h FROM supplier),
b AS (SELECT s_suppkey, min_x, min_y, min_x + w AS max_x, min_y + h AS max_y FROM r)
SELECT s_suppkey, count(*) AS points, min(l_extendedprice) AS low, CAST(sum(l_partkey) AS BIGINT) AS parts FROM lineitem JOIN b ON l_extendedprice BETWEEN min_x AND max_x AND l_quantity BETWEEN min_y AND max_y GROUP BY 1""")
def f85_points_in_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of (extended price, quantity) in rectangles of sizes between 1 by 1/4 and 8192 by 8 that overlap."""
    k = F.col("s_suppkey")
    r = read(spark, sf_dir, "supplier").select(k, ((k * 7919) % 90000).cast("double").alias("min_x"), ((k * 31) % 50).cast("double").alias("min_y"))
    r = r.withColumns({"max_x": F.col("min_x") + F.pow(F.lit(2.0), k % 14), "max_y": F.col("min_y") + F.pow(F.lit(2.0), k % 6) / 4})
    sums = rectangle_sums.sums_in_rectangles(read(spark, sf_dir, "lineitem"), r, "s_suppkey", "l_extendedprice", "l_quantity", "l_partkey")
    return sums.withColumnsRenamed({"number": "points", "total": "parts"}).select("s_suppkey", "points", "low", "parts")
