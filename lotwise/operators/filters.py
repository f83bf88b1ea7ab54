"""Choosing entries inside a listing's JSON: prices by business type, media, amounts; usable responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import parse_int_variant


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def price_of(infos: Column, business: str) -> Column:
    """The first price entry of a business type."""
    return F.get(F.filter(infos, lambda p: text_at(p, "$.businessType") == business), F.lit(0))


def rental_row(prices: Column) -> Column:
    """The first RENTAL price row by businessType or business, else the first object."""
    rental = F.filter(prices, lambda p: F.coalesce(text_at(p, "$.businessType") == "RENTAL", F.lit(False)) | F.coalesce(text_at(p, "$.business") == "RENTAL", F.lit(False)))
    objects = F.filter(prices, lambda p: F.schema_of_variant(p).startswith("OBJECT"))
    return F.coalesce(F.get(rental, F.lit(0)), F.get(objects, F.lit(0)))


def amount_of(operations: Column, operation: str, currency: str = "3") -> Column:
    """The first readable amount among the prices of an operation type in a currency; 3 is the default currency."""
    chosen = F.filter(operations, lambda o: text_at(o, "$.operationType.operationTypeId") == operation)
    prices = F.flatten(F.transform(chosen, lambda o: F.coalesce(F.try_variant_get(o, "$.prices", "array<variant>"), F.array().cast("array<variant>"))))
    own = F.filter(prices, lambda p: F.coalesce(text_at(p, "$.currencyId"), F.lit("3")) == currency)
    amounts = F.filter(F.transform(own, lambda p: parse_int_variant(F.try_variant_get(p, "$.amount", "variant"), None)), lambda a: a.isNotNull())
    return F.coalesce(F.get(amounts, F.lit(0)), F.lit(0).cast("bigint"))


def image_links(medias: Column) -> Column:
    """Links of the media entries that are images."""
    return F.filter(F.transform(F.filter(medias, lambda m: text_at(m, "$.type") == "IMAGE"), lambda m: text_at(m, "$.url")), lambda u: F.coalesce(u != "", F.lit(False)))


def feature_value(posting: Column, code: str, default: int = 0) -> Column:
    return parse_int_variant(F.try_variant_get(posting, f"$.mainFeatures.{code}.value", "variant"), default)


def amount_field(posting: Column, name: str) -> Column:
    """A field that is an amount or an object with one."""
    inner = F.try_variant_get(posting, f"$.{name}.amount", "variant")
    return parse_int_variant(F.coalesce(inner, F.try_variant_get(posting, f"$.{name}", "variant")))


def thumb_of(posting: Column) -> Column:
    """Link of the first picture, the largest size first."""
    sizes = ("url730x532", "url360x266", "url130x70")
    return F.coalesce(*(F.nullif(text_at(posting, f"$.visiblePictures.pictures[0].{s}"), F.lit("")) for s in sizes), F.lit(""))


def usable_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses (source, url, status, body) with a JSON body and status 200, as a variant; and the rest with a reason."""
    parsed = responses.withColumn("json", F.try_parse_json("body"))
    failed = F.coalesce(F.try_variant_get("json", "$.erro", "string"), F.lit("")).isin("", "false", "0")
    reason = F.when(~F.coalesce(F.col("status") == 200, F.lit(False)), "status").when(F.col("json").isNull(), "not_json").when((F.col("source") == "netimoveis") & ~failed, "source_error")
    tagged = parsed.withColumn("code", reason)
    return tagged.where("code IS NULL").drop("code", "body"), tagged.where("code IS NOT NULL").select("source", "url", "status", "code")


def with_url(df: DataFrame, column: str = "url") -> DataFrame:
    return df.where(F.coalesce(F.col(column), F.lit("")) != "")
