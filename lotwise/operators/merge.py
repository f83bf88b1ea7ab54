"""Joins of listing records: listings with map points, details with list records, loaded snapshots, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.texts import title_case
from .dedupe import last_wins
from .records import BASE, ZEROS


def coalesced(left: DataFrame, right: DataFrame, key: str, columns: list[str], how: str = "left", mode: str = "faithful") -> DataFrame:
    """Left joined with right by key, each column the left value or else the right one.

    faithful: only null gives way, so zero-filled base columns never do. fill_zero: 0 and empty texts give way too.
    """
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), how)

    def pick(c: str) -> Column:
        x, y = F.col(f"a.{c}") if c in left.columns else F.lit(None), F.col(f"b.{c}") if c in right.columns else F.lit(None)
        kind = dict(left.dtypes).get(c)
        if mode == "fill_zero" and kind in ZEROS:
            return F.coalesce(F.nullif(x, F.lit(ZEROS[kind])), y, x)
        return F.coalesce(x, y)

    return joined.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), *(pick(c).alias(c) for c in columns if c != key))


def listings_and_points(listings: DataFrame, points: DataFrame, seq: list[str]) -> DataFrame:
    """Full outer join by text id: (id, listing, point). Ids without a listing become stubs; empty ids are dropped."""
    one = last_wins(listings.where("id <> ''"), ["id"], seq).select("id", F.col("raw").alias("listing"))
    two = last_wins(points.where("id <> ''"), ["id"], seq).select("id", F.col("raw").alias("point"))
    return one.join(two, "id", "full_outer").withColumn("stub", F.col("listing").isNull())


def points_and_cards(points: DataFrame, cards: DataFrame, seq: list[str], mode: str = "faithful") -> DataFrame:
    """Points with what their cards (the last of each id) add, one row per URL, the last; cards without a point and rows without a URL go."""
    one_card = last_wins(cards.where("id <> 0"), ["id"], seq).drop(*seq)
    merged = coalesced(points, one_card, "id", points.columns, mode=mode)
    return last_wins(merged.where(F.coalesce(F.col("url"), F.lit("")) != ""), ["url"], [*seq, "id"])


def detail_and_list(details: DataFrame, records: DataFrame, mode: str = "faithful") -> DataFrame:
    """Detail records completed by the list's records of the same id."""
    return coalesced(details, records, "id", [*details.columns, *(c for c in records.columns if c not in details.columns)], mode=mode)


def not_loaded(files: DataFrame, loaded: DataFrame, keys: tuple[str, ...] = ("stamp", "site"), skip: bool = True) -> DataFrame:
    """Files whose snapshot is not loaded yet. Spark broadcasts the keys only below its size threshold."""
    return files.join(loaded.select(*keys).distinct(), list(keys), "left_anti") if skip else files


def loaded_keys(facts: DataFrame) -> DataFrame:
    """Distinct (stamp, site) of a fact table with scrapy_date and source_site."""
    return facts.select(F.date_format("scrapy_date", "yyyy-MM-dd_HH-mm").alias("stamp"), F.col("source_site").alias("site")).distinct()


def with_label(df: DataFrame, code: str, labels: DataFrame, out: str) -> DataFrame:
    """Looks up (code, label) rows; codes without a label become words with capitals, blanks stay blank."""
    c = F.trim(F.coalesce(F.col(code), F.lit("")))
    named = df.withColumn("_code", c).join(labels.select(F.col("code").alias("_code"), F.col("label").alias("_label")), "_code", "left")
    return named.withColumn(out, F.coalesce("_label", title_case(F.replace(F.col("_code"), F.lit("_"), F.lit(" "))))).drop("_code", "_label")


def geocoded(df: DataFrame, address: str, lookup: DataFrame) -> DataFrame:
    """Adds lat and lon of a supplied table (address, lat, lon) of looked-up addresses."""
    from ..functions.geo import geocoding_text

    found = lookup.select(F.col("address").alias("_address"), "lat", "lon").dropDuplicates(["_address"])
    return df.withColumn("_address", geocoding_text(F.col(address))).join(found, "_address", "left").drop("_address")


__all__ = ["BASE", "coalesced", "detail_and_list", "geocoded", "listings_and_points", "loaded_keys", "not_loaded", "points_and_cards", "with_label"]
