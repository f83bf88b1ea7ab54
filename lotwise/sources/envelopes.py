"""Response envelopes: where each source keeps its rows and its totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Paths of the rows of each source's responses.
ROWS = {
    "vivareal": "$.search.result.listings", "vivareal_map": "$.search.result.maps", "netimoveis": "$.lista",
    "quintoandar": "$.hits.hits", "casamineira": "$.listPostings", "zapimoveis": "$.search.result.listings",
}
# Paths of the totals, the first that is there counts.
TOTALS = {
    "vivareal": ["$.search.totalCount", "$.search.result.totalCount"], "quintoandar": ["$.hits.total.value"],
    "casamineira": ["$.paging.totalPages"], "zapimoveis": ["$.search.totalCount", "$.search.result.totalCount"],
}


def unwrap(responses: DataFrame, source: str, json: str = "json") -> DataFrame:
    """One row per element of the envelope's list, objects only: the other columns, pos and raw."""
    kept = [c for c in responses.columns if c != json]
    rows = responses.select(*kept, F.posexplode(F.try_variant_get(json, ROWS[source], "array<variant>")).alias("pos", "raw"))
    return rows.where(F.schema_of_variant("raw").startswith("OBJECT"))


def total(json: Column, source: str) -> Column:
    """Number of listings (of pages, for casamineira) that a response reports."""
    return F.coalesce(*(F.try_variant_get(json, p, "bigint") for p in TOTALS[source]))


def page_total(content: Column) -> Column:
    """totalCount in the embedded JSON of a list page; 0 counts as missing."""
    return F.nullif(F.try_variant_get(content, "$.children[0][3].content.totalCount", "bigint"), F.lit(0))
