"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words and are stripped from lines: space, tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z and nothing else, for Python strings.
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which the driver and all executors share.

    Where it is unset, a fresh temporary one on a local master, whose tasks share the machine; an error on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def cut(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write df below the shared folder, in folders by columns, and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    for made in _scratch:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """The paths that cut() writes to inside; what is still in the list at the end is removed. Nothing read later may need it."""
    made: list[str] = []
    _scratch.append(made)
    try:
        yield made
    finally:
        _scratch.remove(made)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores before them as keep them apart from all columns of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, other letters unchanged; lower() serves where all characters are ASCII."""
    return F.when(F.char_length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id's text mod folds = fold; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def pieces(batch_rows: int, column_lists: Iterator) -> Iterator:
    """Cut an iterator of equally long column lists into runs of at most batch_rows rows."""
    for columns in column_lists:
        n = len(columns[0])
        for at in range(0, n, batch_rows):
            yield [c[at : at + batch_rows] for c in columns]
