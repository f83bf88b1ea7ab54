"""New snapshot files, each loaded once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.facts import FactTable, whole


def snapshot_stream(spark: SparkSession, directory: str, files_at_once: int | None = None) -> DataFrame:
    """path, file_name and body of the files of a directory as they come; several snapshots may come at once."""
    reader = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.json")
    raw = (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).load(directory)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("body"))


def ingest(spark: SparkSession, directory: str, facts: str, checkpoint: str, sites: list[str] | None = None, files_at_once: int | None = None):
    """Loads all files of a directory not seen yet into the fact table and ends."""
    return ingest_files(snapshot_stream(spark, directory, files_at_once), facts, checkpoint, sites)


def ingest_files(files: DataFrame, facts: str, checkpoint: str, sites: list[str] | None = None):
    """Loads a stream of files (file_name, body, perhaps path) into the fact table, each batch as one transaction.

    A batch that runs again after its commit changes nothing. Rows and files that are kept out go to quarantine with their
    reason. Of files of one site and stamp the first that comes is loaded; the ledger names every other as skipped.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]  # a new checkpoint is a new stream
        FactTable(spark, facts).load(whole(df), f"{stream}-{number}", sites)

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_facts(facts: DataFrame) -> DataFrame:
    """Rows of each site's newest snapshot by its stamp, whenever it came."""
    newest = facts.groupBy("source_site").agg(F.max("scrapy_date").alias("scrapy_date"))
    return facts.join(newest, ["source_site", "scrapy_date"])
