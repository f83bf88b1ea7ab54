"""Lists of listings: first values, safe elements, image links, amenity labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .once import bound, unless
from .texts import amenity_label


def first_value(values: Column) -> Column:
    return F.get(values, F.lit(0))


def first_of_variant(value: Column) -> Column:
    """First element of a JSON list; any other value as it is."""
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), F.try_variant_get(value, "$[0]", "variant")).otherwise(value)


def element(values: Column, index: int) -> Column:
    """The element at an index from 0, or from the end if negative; null outside."""
    return F.try_element_at(values, F.lit(index + 1 if index >= 0 else index))


def image_urls(images: Column) -> Column:
    """Links of an array of JSON objects with dangerousSrc, blanks dropped."""
    links = F.transform(images, lambda x: F.trim(F.try_variant_get(x, "$.dangerousSrc", "string")))
    return F.filter(links, lambda x: x.isNotNull() & (x != ""))


def amenity_item_label(item: Column) -> Column:
    """A text, or the first text among name, label, text, description and title of an object."""
    own = F.when(F.schema_of_variant(item) == "STRING", F.try_variant_get(item, "$", "string"))
    fields = [F.try_variant_get(item, f"$.{k}", "string") for k in ("name", "label", "text", "description", "title")]
    return F.coalesce(*(unless(F.trim(x), "") for x in (own, *fields)))


def amenity_labels(codes: Column) -> Column:
    """Labels of codes without blanks; null if none is left."""
    labels = F.filter(F.transform(codes, amenity_label), lambda x: x != "")
    return bound(labels, lambda found: F.when(F.size(found) > 0, found))
