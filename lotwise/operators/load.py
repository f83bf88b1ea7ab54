"""Sinks: snapshot tables, the stamped fact table, exports, and what was loaded."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dedupe import last_wins
from .tables import written

BATCH_ROWS = 500
REPORT = "file_name string, status string, rows long, error string"


def write_snapshot(rows: DataFrame, path: str, key: str, seq: list[str], fmt: str = "json") -> None:
    """The last row of each id, as files below site and stamp; replaces the snapshots that rows holds and no others."""
    current = last_wins(rows, ["site", "stamp", key], seq).write.partitionBy("site", "stamp").mode("overwrite")
    current.option("partitionOverwriteMode", "dynamic").format(fmt).save(path)


def write_unified(unified: DataFrame, path: str) -> None:
    """Compact JSON rows, UTF-8."""
    unified.write.mode("overwrite").json(path)


def export_json(df: DataFrame, path: str) -> None:
    """Every row of a table as a JSON text of its columns."""
    json_rows(df).write.mode("overwrite").text(path)


def json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def publish(df: DataFrame, destinations: str) -> DataFrame:
    """Writes to every destination of a list split by comma, bar or semicolon; (dest, status, error). One that fails does not stop the rest.

    Rows are computed once: destinations get what was written first.
    """
    spark, out = df.sparkSession, []
    rows = written(df, "published")
    for dest in (d.strip() for d in re.split(r"[,|;]", destinations) if d.strip()):
        try:
            rows.write.mode("overwrite").json(dest)
            out.append((dest, "ok", None))
        except Exception as e:  # noqa: BLE001  the report holds it
            out.append((dest, "error", str(e).splitlines()[0][:300]))
    return spark.createDataFrame(out, "dest string, status string, error string")


def load_snapshot_table(rows: DataFrame, table: str, reload: bool = False) -> str:
    """One table per snapshot: created, reloaded, or skipped_exists."""
    spark = rows.sparkSession
    there = spark.catalog.tableExists(table)
    if there and not reload:
        return "skipped_exists"
    rows.write.mode("overwrite").saveAsTable(table)
    return "reloaded" if there else "created"


def append_facts(rows: DataFrame, path: str) -> None:
    """Replaces exactly the snapshots that rows holds, so a replay changes nothing; partitions are scrapy_date and source_site.

    Rebalancing gives small snapshots few files and splits a large one over tasks.
    """
    day = rows.withColumn("scrapy_date", F.date_format("scrapy_date", "yyyy-MM-dd_HH-mm"))
    day.hint("rebalance", "scrapy_date", "source_site").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scrapy_date", "source_site").parquet(path)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """The fact table with its timestamp restored."""
    df = spark.read.option("partitionColumnTypeInference", "false").parquet(path)
    return df.withColumn("scrapy_date", F.try_to_timestamp(F.col("scrapy_date").cast("string"), F.lit("yyyy-MM-dd_HH-mm")))


def ensure_table(spark: SparkSession, table: str, ddl: str, truncate: bool = False) -> None:
    """Creates a table and its database if they are missing; truncate drops it first."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    if truncate:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    df.write.jdbc(url, table, mode="append", properties={"batchsize": str(BATCH_ROWS)} | (properties or {}))


def file_report(files: DataFrame, loaded: DataFrame, rows: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Per file: inserted, skipped_source_loaded or error, its rows and error; a file without rows counts as inserted with 0."""
    counts = rows.groupBy("file_name").agg(F.count("*").alias("n"))
    out = files.join(loaded.select("stamp", "site", F.lit(True).alias("_loaded")).distinct(), ["stamp", "site"], "left").join(counts, "file_name", "left")
    if failed is None:
        out = out.withColumn("error", F.lit(None).cast("string"))
    else:
        out = out.join(failed.select("file_name", "error"), "file_name", "left")
    status = F.when(F.col("_loaded"), "skipped_source_loaded").when(F.col("error").isNotNull(), "error").otherwise("inserted")
    return out.select("file_name", status.alias("status"), F.when(status == "inserted", F.coalesce("n", F.lit(0))).otherwise(0).alias("rows"), "error")


def report_totals(report: DataFrame) -> DataFrame:
    """Loaded, skipped and failed files, and the rows of the loaded ones."""
    good = F.col("status").isin("inserted", "created", "reloaded")
    return report.agg(
        F.count_if(good).alias("loaded"), F.count_if(F.col("status").startswith("skipped")).alias("skipped"), F.count_if(F.col("status") == "error").alias("errors"),
        F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("rows"),
    )


def duplicate_uids(facts: DataFrame) -> DataFrame:
    """uids that are there more than once: the check that replaces a primary key."""
    return facts.groupBy("uid").agg(F.count("*").alias("n")).where("n > 1")
