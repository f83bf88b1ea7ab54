"""Tables written between steps of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the folder in spark.checkpoint.dir, which the driver and all executors share.

    Where that is unset, a temporary folder on a local master, whose tasks share the machine; an error on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written below the folder in spark.checkpoint.dir and read back, so later steps don't compute it again."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over as many tasks as a shuffle has: for small rows that much work is done on, since a small file is read by few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
