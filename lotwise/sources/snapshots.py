"""Snapshot files named YYYY-MM-DD_HH-MM_site.json: which exist, which is newest, and the rows they hold."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import stamp_to_timestamp
from ..functions.texts import table_name
from ..operators.dedupe import last_wins, with_priority

# Names of snapshot files.
NAME = r"^(\d{4}-\d{2}-\d{2}_\d{2}-\d{2})_([a-zA-Z0-9_]+)\.json$"
# The known sites in the order of the unified view.
SITES = ["quintoandar", "vivareal", "netimoveis", "zapimoveis", "casamineira"]
# Names of outputs that lie beside the snapshots.
OUTPUTS = ["imoveis_unificados", "imoveis_unificados_minified"]
OUTPUT_PREFIX = "_upload_merge_"
#: The provider that once exported rent and sale apart.
OLDER_EXPORTS = "zapimoveis"


def stamp_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, NAME, 1), F.lit(""))


def site_of(name: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(name, NAME, 2)), F.lit(""))


def with_names(files: DataFrame) -> DataFrame:
    """Adds stamp, site, snapshot_ts and table_name to file_name; other names and impossible stamps give null."""
    f = F.col("file_name")
    return files.withColumns({"stamp": stamp_of(f), "site": site_of(f), "snapshot_ts": stamp_to_timestamp(stamp_of(f)), "table_name": table_name(f)})


def is_output(site: Column) -> Column:
    return site.isin(OUTPUTS) | site.startswith(OUTPUT_PREFIX)


def loadable(files: DataFrame, sites: list[str] | None = None) -> DataFrame:
    """Snapshots of the known sites, without outputs and impossible stamps."""
    named = with_names(files)
    return named.where(F.col("snapshot_ts").isNotNull() & ~is_output(F.col("site")) & F.col("site").isin(sites or SITES))


def impossible(files: DataFrame) -> DataFrame:
    """Files named like snapshots whose stamp is no minute of any day, with the reason why they are kept out."""
    named = with_names(files).where(F.col("stamp").isNotNull() & F.col("snapshot_ts").isNull())
    return named.select("file_name", "site", "stamp", F.lit("impossible_stamp").alias("code"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows of sites in the order of their names."""
    return rows.orderBy("site")


def newest_per_site(files: DataFrame) -> DataFrame:
    """The newest snapshot of each site, known or not; of equal stamps the first by file name. Impossible stamps are left out."""
    named = with_names(files).where(F.col("snapshot_ts").isNotNull() & ~is_output(F.col("site")))
    first = Window.partitionBy("site").orderBy(F.col("snapshot_ts").desc(), "file_name")
    return named.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def select_sites(wanted: str | None, known: list[str] = SITES) -> list[str]:
    """Sites of a comma or semicolon list in their fixed order; all without a list, none for 'none'."""
    if wanted is None or not wanted.strip():
        return list(known)
    names = {w.strip().lower() for w in re.split("[,;]", wanted) if w.strip()}
    if names == {"none"}:
        return []
    if unknown := names - {k.lower() for k in known}:
        raise ValueError(f"unknown sources: {', '.join(sorted(unknown))}")
    return [k for k in known if k.lower() in names]


def read_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file_name, path and body of snapshot files."""
    raw = spark.read.text(paths, wholetext=True)
    return raw.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """file_name and path without reading the bodies."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(directory).select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")


def explode_body(files: DataFrame) -> DataFrame:
    """One row per listing: columns of files but body, key, pos and raw (variant). Of equal keys the last stays.

    The body's root is an object of listings by id or an array of listings; other roots give no rows. A body is one
    value of at most 2 GB and is parsed by one task: larger ones are read by bodies.cut_bodies, lines by json_lines.
    """
    kept = [c for c in files.columns if c != "body"]
    body, root = F.col("body"), F.left(F.ltrim("body"), F.lit(1))
    by_key = F.transform(F.map_entries(F.from_json(body, "map<string,variant>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("raw")))
    listed = F.transform(F.from_json(body, "array<variant>"), lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("raw")))
    rows = files.select(*kept, F.posexplode(F.when(root == "{", by_key).when(root == "[", listed)).alias("pos", "item")).select(*kept, "pos", "item.key", "item.raw")
    same = F.coalesce(F.concat(F.lit("="), F.col("key")), F.col("pos").cast("string"))
    return rows.withColumn("_last", F.max("pos").over(Window.partitionBy("path" if "path" in kept else "file_name", same))).where("pos = _last").drop("_last")


def json_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Listings of exports with one JSON object a line: file_name and raw. Spark splits such files over tasks."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_name").alias("file_name"), F.try_parse_json("value").alias("raw"))
    return listings(lines)


def listings(rows: DataFrame) -> DataFrame:
    """Rows whose raw value is an object with an id that is not null."""
    raw = F.col("raw")
    return rows.where(F.schema_of_variant(raw).startswith("OBJECT") & F.try_variant_get(raw, "$.id", "string").isNotNull())


def latest_for_provider(files: DataFrame, provider: str) -> DataFrame:
    """The provider's newest snapshot; without one, for the provider with older exports the newest of rent and sale, sale first by priority."""
    provider = provider.lower()
    names = [provider, f"{provider}_venda", f"{provider}_aluguel"] if provider == OLDER_EXPORTS else [provider]
    parts = F.create_map(*(F.lit(x) for k, name in enumerate(names) for x in (name, k)))
    found = newest_per_site(files).withColumn("priority", F.try_element_at(parts, F.col("site"))).where("priority IS NOT NULL")
    own = F.min("priority").over(Window.partitionBy())  # three rows at most
    return found.withColumn("_own", own).where("priority = 0 OR _own > 0").drop("_own")


def combine_legacy(rent: DataFrame, sale: DataFrame, key: str = "key") -> DataFrame:
    """Rows of an older pair of exports; of equal keys the sale row stays."""
    return with_priority([sale, rent], key)


def unified(rows: DataFrame, sites: list[str] | None = None) -> DataFrame:
    """Adds source_rank, the place of a row's site in the fixed order; rows of other sites are dropped."""
    order = F.array(*map(F.lit, sites or SITES))
    return rows.withColumn("source_rank", F.array_position(order, F.col("site"))).where("source_rank > 0")


def id_keyed(rows: DataFrame, key: str, seq: list[str]) -> DataFrame:
    """Rows as a snapshot keeps them: the last of each id."""
    return last_wins(rows, [key], seq)
