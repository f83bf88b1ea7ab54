"""From raw documents to packed training sequences, in five stages over whole tables.

Null and empty texts pass all stages (near dedup links them with nothing); a null id is an id like any other to line
dedup and mixing and is linked with nothing. Very long texts are worked on whole. Of equal documents near dedup keeps the
smallest id and all rows of it; other ties are those of the operators. Empty tables give empty tables. Extra columns of
any name are kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import line_dedup, mixing, near_dups, packing, toxicity
from lotwise.llm.common import cut, remove, scratch, table
from lotwise.llm.queries import tokenizer_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels, does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat across documents; n_chars follows the text."""
    out = line_dedup.without_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; shingles of five words, as for all near duplicates but op6's contract."""
    return near_dups.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Several stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as made:
            docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            written = made.pop()
        if before:
            remove(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
