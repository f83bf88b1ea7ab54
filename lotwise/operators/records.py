"""The listing record: its columns, default values, unified, snapshot and fact forms."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import stamp_to_timestamp
from ..functions.texts import fill_thumb

# The fields of a listing record, in order.
BASE_SCHEMA = (
    "id long, url string, thumb string, aluguel int, venda int, iptu int, condominio int, banheiros int, quartos int, "
    "vagas int, area int, bairro string, tipo_imovel string, endereco string, lat double, long double"
)
BASE_KINDS = dict(f.split() for f in BASE_SCHEMA.split(", "))
BASE = list(BASE_KINDS)
ZEROS = {"bigint": 0, "int": 0, "double": 0.0, "string": ""}
#: Namespace of the rows' ids.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "lotwise:rows")
UNIFIED = [*BASE[:-1], "lon", "fonte"]
SNAPSHOT = ["uid", "internal_id", *UNIFIED, "full_item_json"]
STAMPED = ["uid", "internal_id", "scrapy_date", *UNIFIED, "full_item_json"]


def fill_defaults(df: DataFrame) -> DataFrame:
    """Missing base columns become 0, 0.0 or an empty text; columns of an extension stay null."""
    return df.fillna({c: ZEROS[t] for c, t in df.dtypes if c in BASE and t in ZEROS})


def base_columns(df: DataFrame) -> DataFrame:
    """Base columns only, days as ISO texts."""
    kinds = dict(df.dtypes)
    return df.select(*(F.date_format(c, "yyyy-MM-dd").alias(c) if kinds[c] == "date" else F.col(c) for c in BASE if c in kinds))


def raw_field(raw: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(raw, f"$.{name}", kind)


def unified_from_raw(rows: DataFrame, strict_lon: bool = False) -> DataFrame:
    """Unified rows of raw listings (raw, site): the row's own source name wins over the file's site."""
    raw = F.col("raw")
    lon = raw_field(raw, "lon", "double")
    out = {c: raw_field(raw, c, BASE_KINDS[c]) for c in BASE if c != "long"}
    out["thumb"] = fill_thumb(out["thumb"])
    out["lon"] = lon if strict_lon else F.coalesce(lon, raw_field(raw, "long", "double"))
    out["fonte"] = source_name(raw, F.col("site"))
    return rows.select(*(c for c in rows.columns if c not in out), *(v.alias(c) for c, v in out.items()))


def source_name(raw: Column, site: Column) -> Column:
    return F.coalesce(F.nullif(raw_field(raw, "fonte", "string"), F.lit("")), site)


def snapshot_uid(listing_id: Column, source: Column) -> Column:
    return F.concat_ws("_", listing_id.cast("string"), source)


def stamped_uid(listing_id: Column, source: Column, stamp: Column) -> Column:
    return F.concat_ws("_", listing_id.cast("string"), source, stamp)


def named_uuid(name: Column) -> Column:
    """Name-based UUID (version 5) of a text: the same name has the same one in every run, retry and replay."""
    digest = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE.hex)), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("long").bitwiseAND(3).bitwiseOR(8)))
    parts = [F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.when(name.isNotNull(), F.concat_ws("-", *parts))


def snapshot_rows(unified: DataFrame) -> DataFrame:
    """Unified rows as loaded into a snapshot's table; internal_id follows from uid."""
    uid = snapshot_uid(F.col("id"), F.col("fonte"))
    return unified.withColumns({"uid": uid, "internal_id": named_uuid(uid), "full_item_json": F.col("raw")}).select(*SNAPSHOT)


def stamped_rows(unified: DataFrame) -> DataFrame:
    """Unified rows as loaded into the fact table; also source_site, the file's own site."""
    uid = stamped_uid(F.col("id"), F.col("fonte"), F.col("stamp"))
    cols = {
        "uid": uid, "internal_id": named_uuid(uid), "scrapy_date": stamp_to_timestamp(F.col("stamp")),
        "full_item_json": F.col("raw"), "source_site": F.col("site"),
    }
    return unified.withColumns(cols).select(*STAMPED, "source_site")


def split_valid(df: DataFrame, id_column: str = "id", source_column: str = "fonte") -> tuple[DataFrame, DataFrame]:
    """Rows with an id other than 0 and a source, and the rest with the reason why they are kept out."""
    bad_id = F.coalesce(F.col(id_column) == 0, F.lit(True))
    bad_source = F.coalesce(F.col(source_column) == "", F.lit(True))
    tagged = df.withColumn("code", F.when(bad_id, "missing_id").when(bad_source, "missing_source"))
    message = F.when(F.col("code") == "missing_id", "id is missing or 0").otherwise("source is missing")
    return tagged.where("code IS NULL").drop("code"), tagged.where("code IS NOT NULL").withColumn("message", message)
