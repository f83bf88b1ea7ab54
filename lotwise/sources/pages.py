"""Raw web pages as a source: the table of pages and the JSON that list pages carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import embedded_json

SCRIPT = r'(?is)<script[^>]*>((?:(?!</script>).)*?{marker}(?:(?!</script>).)*)</script>'


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def cards(pages: DataFrame) -> DataFrame:
    """Structured-data cards of list pages: page_id, pos, raw."""
    body = F.regexp_extract("html", SCRIPT.format(marker="numberOfItems"), 1)
    items = F.try_variant_get(F.try_parse_json(F.nullif(body, F.lit(""))), "$.itemListElement", "array<variant>")
    rows = pages.select("page_id", F.posexplode(items).alias("pos", "element"))
    return rows.select("page_id", "pos", F.try_variant_get("element", "$.item", "variant").alias("raw"))


def points(pages: DataFrame) -> DataFrame:
    """Map points of list pages: page_id, pos, raw."""
    content = embedded_json(F.col("html"), r'\\"lat\\"')
    listed = F.try_variant_get(content, "$.children[0][3].content.listings", "array<variant>")
    return pages.select("page_id", F.posexplode(listed).alias("pos", "raw"))
