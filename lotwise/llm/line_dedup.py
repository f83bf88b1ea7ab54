"""Line deduplication with levelled sorted runs of line hashes.

A run holds (h1, h2, n_docs, keeper): a line key's two 64-bit hashes, in how many
documents of the run's batches it was found, and the largest document id holding it
where that was first seen in the run. Batches come in descending order of document
id. Each batch is aggregated, merge-anti-joined with the runs (keys they lack are
fresh and get their keeper from this batch), and written as a run of level 0. When a
level holds FANOUT runs they are compacted into one run of the next level. Runs are
tables of equal buckets, each sorted, so joins and compactions merge them bucket by
bucket and shuffle nothing but the batch. They stay under a name, by which a later job
opens them and adds its own batches.

A key is a line without blanks at both ends, A-Z lower-cased. Keys of at least
min_chars code points found in at least min_docs documents lose all their lines
except in the largest document id holding it.

Rows that share a document id are one document to the counts; each row gives an
output row. A null id is the smallest id. A null or empty text is one empty line, a very
long one is split whole. Ids decide alone, so there are no ties. An empty table gives no
rows. Extra columns are ignored by dedup_lines() and kept by without_repeats(), whatever
their names. DataFrame functions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, cut, free_names

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 4, 2
NULL_ID = -(1 << 63)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def hashes(key: Column) -> tuple[Column, Column]:
    low = ascii_lower(key)
    return F.xxhash64(low), F.xxhash64(F.lit(1), low)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Distinct (id, h1, h2) of the keys that are long enough."""
    keys = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), F.explode(lines_of(F.col("text"))).alias("line"))
    keys = keys.select("id", key_of(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    h1, h2 = hashes(F.col("key"))
    return keys.select("id", h1.alias("h1"), h2.alias("h2")).distinct()


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Spark takes a bucket of one sorted file as sorted only under this setting."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """The runs by level, as tables name_level_number; add() takes a batch of distinct (id, h1, h2) whose ids are below those of all earlier batches."""

    def __init__(self, spark: SparkSession, name: str | None = None, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.name = name or f"line_runs_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = [t.name[len(self.name) + 1 :].split("_") for t in spark.catalog.listTables(pattern=f"{self.name}_*")]
        self.levels: dict[int, list[str]] = {}
        for level, number in sorted((int(x), int(y)) for x, y in found):
            self.levels.setdefault(level, []).append(f"{self.name}_{level}_{number}")
        self.written = max((int(y) for _, y in found), default=-1) + 1

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(t) for level in sorted(self.levels) for t in self.levels[level]]

    def add(self, batch: DataFrame) -> None:
        found = batch.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id").alias("keeper")).repartition(self.buckets, "h1", "h2")
        for run in self.runs():  # a key that any run holds has its keeper there
            known = run.select("h1", "h2", F.lit(True).alias("known")).hint("merge")
            found = found.join(known, ["h1", "h2"], "left").withColumn("keeper", F.when(F.col("known").isNull(), F.col("keeper"))).drop("known")
        self._put(found, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        table = f"{self.name}_{level}_{self.written}"
        self.written += 1
        with sorted_buckets(self.spark):
            run.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(table)
        held = self.levels.setdefault(level, [])
        held.append(table)
        if len(held) == self.fanout:
            self._put(merged([self.spark.table(t) for t in held]), level + 1)
            for t in held:
                self.spark.sql(f"DROP TABLE {t}")
            self.levels[level] = []

    def frequent(self, min_docs: int) -> DataFrame:
        """(h1, h2, keeper) of the keys of so many documents, written."""
        with sorted_buckets(self.spark):
            return cut(merged(self.runs()).where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper"), "frequent-lines")

    def drop(self) -> None:
        for tables in self.levels.values():
            for t in tables:
                self.spark.sql(f"DROP TABLE {t}")
        self.levels = {}


def merged(runs: list[DataFrame]) -> DataFrame:
    """One run of several: their sorted buckets are merged."""

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select("h1", "h2", F.col("n_docs").alias("n_other"), F.col("keeper").alias("other"))
        total = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_other", F.lit(0))
        return a.join(b.hint("merge"), ["h1", "h2"], "full_outer").select("h1", "h2", total.alias("n_docs"), F.coalesce("keeper", "other").alias("keeper"))

    return reduce(both, runs)


def gone_lines(docs: DataFrame, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """(id, gone): the key hashes that a document loses."""
    keys = cut(line_keys(docs, min_chars), "line-keys")
    bounds = keys.agg(F.percentile_approx("id", [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    runs, below = LineRuns(docs.sparkSession), None
    for bound in [*sorted(set(bounds), reverse=True), None]:
        batch = keys if bound is None else keys.where(F.col("id") > bound)
        runs.add(batch if below is None else batch.where(F.col("id") <= below))
        below = bound
    frequent = runs.frequent(min_docs)
    runs.drop()
    gone = keys.join(frequent, ["h1", "h2"]).where("id < keeper").groupBy("id").agg(F.collect_list(F.struct("h1", "h2")).alias("gone"))
    return cut(gone, "gone-lines")


def kept_lines(text: Column, gone: Column, min_chars: int) -> Column:
    """Lines of a text without the gone ones; null where none is gone."""

    def stays(line: Column) -> Column:
        key = key_of(line)
        h1, h2 = hashes(key)
        return (F.char_length(key) < min_chars) | ~F.array_contains(gone, F.struct(h1.alias("h1"), h2.alias("h2")))

    return F.when(gone.isNotNull(), F.filter(lines_of(text), stays))


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """docs with text replaced by the kept lines, where any line goes; all other columns stay."""
    found, id_, gone, kept = (gone_lines(docs.select("doc_id", "text"), min_chars, min_docs, batches), *free_names(docs, "id", "gone", "kept"))
    out = docs.withColumn(id_, F.coalesce("doc_id", F.lit(NULL_ID))).join(found.withColumnsRenamed({"id": id_, "gone": gone}).hint("merge"), id_, "left")
    out = out.withColumn(kept, kept_lines(F.col("text"), F.col(gone), min_chars))
    return out.withColumn("text", F.when(F.col(kept).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).select(*docs.columns)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """doc_id, text of the kept lines, n_lines before, n_dropped of every row."""
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"))
    out = docs.join(gone_lines(docs, min_chars, min_docs, batches).hint("merge"), "id", "left")
    out = out.withColumn("n_lines", F.size(lines_of(F.col("text"))).cast("long")).withColumn("kept", kept_lines(F.col("text"), F.col("gone"), min_chars))
    text = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n"))
    return out.select("doc_id", text.alias("text"), "n_lines", F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"))


#: DuckDB SQL for the digest of dedup_lines over documents.
SQL = """
WITH blanks AS (SELECT chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS b),
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, b), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines, blanks),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> f.keeper, FALSE) AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
