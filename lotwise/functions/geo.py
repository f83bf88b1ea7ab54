"""Coordinates of listings, as structs (lat, lon)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .once import bound
from .texts import first_truthy


def valid_point(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def point(lat: Column, lon: Column) -> Column:
    """struct(lat, lon), or null if either is missing or out of range."""
    pair = F.struct(lat.alias("lat"), lon.alias("lon"))
    return bound(pair, lambda p: F.when(valid_point(p["lat"], p["lon"]), F.struct(p["lat"].cast("double").alias("lat"), p["lon"].cast("double").alias("lon"))))


def number_of(value: Column, path: str) -> Column:
    """A JSON number at a path; texts do not count."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    return F.when(~kind.rlike("^(STRING|BOOLEAN|OBJECT|ARRAY|VOID)"), F.try_variant_get(value, path, "double"))


def point_of_text(text: Column) -> Column:
    """Point of 'lat,lon'."""
    parts = F.split(text, ",")
    two = F.when(F.size(parts) == 2, parts)
    return point(F.trim(F.get(two, F.lit(0))).try_cast("double"), F.trim(F.get(two, F.lit(1))).try_cast("double"))


def truthy_coordinate(*values: Column) -> Column:
    """The first value that is neither null nor 0, else 0."""
    return F.coalesce(first_truthy(*values, zero=0.0), F.lit(0.0))


def given_coordinate(*values: Column) -> Column:
    """The first value that is not null, 0 included, else 0."""
    return F.coalesce(*values, F.lit(0.0))


def widget_point(data: Column) -> Column:
    """Point of a map widget's JSON: lat/lng names, a GeoJSON position, or either below location."""

    def at(base: str) -> list[Column]:
        lat = F.coalesce(*(F.try_variant_get(data, f"{base}.{k}", "double") for k in ("lat", "latitude")))
        lon = F.coalesce(*(F.try_variant_get(data, f"{base}.{k}", "double") for k in ("lng", "lon", "longitude")))
        geo = F.try_variant_get(data, f"{base}.coordinates", "array<double>")
        return [point(lat, lon), point(F.get(geo, F.lit(1)), F.get(geo, F.lit(0)))]

    return F.coalesce(*at("$"), *at("$.location"), *at("$.location.location"))


def decoded(text: Column, plus: bool = True) -> Column:
    """Percent-decoded text; what is no valid encoding stays as it is. A plus is a space only in query fields."""
    spaced = F.replace(text, F.lit("+"), F.lit(" ")) if plus else text
    return F.coalesce(F.try_url_decode(text if plus else F.replace(text, F.lit("+"), F.lit("%2B"))), spaced)


def query_fields(url: Column) -> Column:
    """array of struct(name, value) of a link's query, in order, without blank values. Any text is read, valid link or not."""
    query = F.regexp_extract(F.trim(url), r"^[^?#]*\?([^#]*)", 1)
    parts = F.transform(F.split(query, "&"), lambda p: F.struct(F.substring_index(p, "=", 1).alias("name"), F.when(p.contains("="), F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("value")))
    return F.transform(F.filter(parts, lambda p: F.coalesce(p["value"] != "", F.lit(False))), lambda p: F.struct(decoded(p["name"]).alias("name"), decoded(p["value"]).alias("value")))


def field_of(fields: Column, name: str) -> Column:
    """The first value of a name, decoded a second time as links in pages are encoded twice."""
    return decoded(F.trim(F.get(F.filter(fields, lambda f: f["name"] == name), F.lit(0))["value"]), plus=False)


# Links of embedded maps, with or without a scheme.
MAP_LINK = r"(?i)(?:https?:)?//(?:www\.)?google\.com/maps/embed[^\"'<>]+"


def map_links(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(MAP_LINK), F.lit(0)), lambda u: F.replace(F.replace(u, F.lit("&amp;"), F.lit("&")), F.lit("&#38;"), F.lit("&")))


def map_link_params(html: Column) -> Column:
    """struct(center, q, key) of the first map link that has any parameters; key of the first that has one."""

    def named(fields: Column) -> Column:
        key = F.get(F.filter(F.transform(fields, lambda f: field_of(f, "key")), lambda k: F.trim(k) != ""), F.lit(0))
        first = F.get(F.filter(fields, lambda f: F.size(f) > 0), F.lit(0))
        return bound(first, lambda f: F.struct(field_of(f, "center").alias("center"), field_of(f, "q").alias("q"), key.alias("key")))

    return bound(F.transform(map_links(html), query_fields), named)


def geocoding_text(address: Column) -> Column:
    """Address as it is looked up: trimmed, of three characters or more, with the country."""
    t = F.trim(address)
    return F.when(F.length(t) >= 3, F.when(F.lower(t).rlike("bra[sz]il"), t).otherwise(F.concat(t, F.lit(", Brazil"))))
