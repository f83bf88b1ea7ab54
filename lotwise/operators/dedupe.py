"""Which of several rows with one key stays. Order is always given by columns, never by arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_wins(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The first row of each key in the order of seq; Spark keeps one row per key and task before it shuffles."""
    return _one(df, keys, [F.col(c).asc() for c in seq])


def last_wins(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    return _one(df, keys, [F.col(c).desc() for c in seq])


def first_and_last(df: DataFrame, keys: list[str], seq: list[str], column: str, first: str, last: str) -> DataFrame:
    """A column's value in the first and in the last row of each key in the order of seq, in one pass."""
    order = F.struct(*seq)
    return df.groupBy(*keys).agg(F.min_by(column, order).alias(first), F.max_by(column, order).alias(last))


def with_priority(parts: list[DataFrame], key: str, seq: list[str] | None = None) -> DataFrame:
    """Union in which, of equal keys, the row of the earlier part stays; within a part the last by seq."""
    union = None
    for k, part in enumerate(parts):
        part = part.withColumn("_part", F.lit(k))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    return _one(union, [key], [F.col("_part"), *(F.col(c).desc() for c in seq or [])]).drop("_part")


def best_candidate(df: DataFrame, keys: list[str], score: str, pos: str) -> DataFrame:
    """The row of the highest score per key, the first by pos of equals."""
    return _one(df, keys, [F.col(score).desc(), F.col(pos)])


def new_per_page(df: DataFrame, key: str, page: str) -> DataFrame:
    """Per page: rows, ids first met there, and whether it is the first page without new ids."""
    first = df.groupBy(key).agg(F.min(page).alias(page)).groupBy(page).agg(F.count("*").alias("new_ids"))
    pages = df.groupBy(page).agg(F.count("*").alias("rows")).join(first, page, "left").withColumn("new_ids", F.coalesce("new_ids", F.lit(0)))
    stop = pages.where("new_ids = 0").agg(F.min(page).alias("_stop"))
    # The stop is one row.
    return pages.crossJoin(F.broadcast(stop)).withColumn("saturated", F.coalesce(F.col(page) == F.col("_stop"), F.lit(False))).drop("_stop")
