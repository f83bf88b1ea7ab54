"""Homomorphic multiset fingerprints of documents.

A fingerprint is a wide vector that is the sum, lane by lane modulo a power of two,
of vectors hashed from the text's paragraphs (its lines). The order of paragraphs
does not matter, and a paragraph can be added or taken away without the rest.

* id lanes: ID_LANES sums modulo 2^62 of a hash of the whole paragraph. They decide equality.
* likeness lanes: 60 sums modulo 2^20 (the last of each word 2^22), three to a word, of the
  bits of a hash of each phrase of the paragraph, and the number of phrases. A bit counts
  as +1 or -1, so the vectors' cosine estimates the cosine of the phrase multisets with a
  standard error of about 1/8.

Equal texts have equal fingerprints. An empty or null text has one empty paragraph.
Phrases lie within a paragraph; empty ones don't count, so an empty paragraph has none.
Each row gives an output row. Documents come in descending order of id, a null id after
all others; texts that share an id come in the order of their hashes, and rows equal in
id and text are one document there, with a row for each. A single document is its own
next. An empty table gives no rows. Extra columns are ignored. A document with over a
million phrases keeps exact id lanes; its likeness lanes carry. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

ID_LANES, WORDS, LANE = 4, 20, 20
MOD = (1 << 62) - 1
#: One bit in each of a word's three lanes.
SPREAD = 1 | 1 << LANE | 1 << (2 * LANE)
#: Phrases end with their paragraph, at punctuation and after words of six characters or more, so an edit moves few of them.
#: Only a separator of its own takes a newline, so the phrases of a text are those of its paragraphs.
PHRASE = r"\n|[.!?,;:|][^\S\n]*|(?<=\S{6})[^\S\n]+"
#: Documents of one ordering task.
ORDER_ROWS, MAX_RANGES = 100_000, 4096
NULL_ID = -(1 << 63)


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def id_lanes(parts: Column) -> Column:
    """Sums of the paragraphs' hashes; equal to the sum of the lanes of any split of the paragraphs."""
    zero = F.lit(0).cast("long")

    def lane(k: int) -> Column:
        return F.aggregate(parts, zero, lambda acc, p: (acc + F.shiftrightunsigned(F.xxhash64(F.lit(k), p), 2)).bitwiseAND(F.lit(MOD)))

    return F.array(*(lane(k) for k in range(ID_LANES)))


def phrase_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(text, PHRASE, -1), ""), lambda p: F.xxhash64(p))


def like_words(hashes: str) -> Column:
    """WORDS words of three lanes each, from an array column of phrase hashes."""
    shifts = ", ".join(map(str, range(WORDS)))
    return F.expr(
        f"aggregate({hashes}, array_repeat(0L, {WORDS}), (acc, h) -> "
        f"zip_with(acc, array({shifts}), (a, j) -> (a + (shiftrightunsigned(h, j) & {SPREAD}L)) & {MOD}L))"
    )


def add(a: Column, b: Column) -> Column:
    """Sum of two vectors of lanes: inserts the paragraphs of b."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MOD)))


def subtract(a: Column, b: Column) -> Column:
    """Difference of two vectors of lanes: deletes the paragraphs of b."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MOD)))


def fingerprint(ids: Column, like: Column, n: Column) -> Column:
    wide = F.transform(ids, lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.concat_ws(".", F.array_join(wide, ""), F.array_join(F.transform(like, lambda x: F.hex(x)), "."), F.hex(n))


def signs(like: Column, n: Column) -> Column:
    """The 60 lanes as +1/-1 sums."""

    def lane(k: int) -> Column:
        mask = (1 << (LANE if k < 2 else LANE + 2)) - 1
        return F.transform(like, lambda x: (2 * F.shiftrightunsigned(x, k * LANE).bitwiseAND(F.lit(mask)) - n).cast("double"))

    return F.concat(*(lane(k) for k in range(3)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def likeness(a: Column, b: Column, same: Column) -> Column:
    """1 for equal fingerprints, else the cosine of the signed lanes, not below 0."""
    size = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(same, 1.0).when(size > 0, F.least(F.greatest(dot(a, b) / size, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)


def with_fingerprint(rows: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds prefix + ids, like and n for a text column."""
    rows = rows.withColumn(f"{prefix}h", phrase_hashes(F.col(text))).withColumn(f"{prefix}p", paragraphs(F.col(text)))
    return (
        rows.withColumn(f"{prefix}ids", id_lanes(F.col(f"{prefix}p")))
        .withColumn(f"{prefix}like", like_words(f"{prefix}h"))
        .withColumn(f"{prefix}n", F.size(f"{prefix}h").cast("long"))
        .drop(f"{prefix}h", f"{prefix}p")
    )


def neighbours(docs: DataFrame) -> DataFrame:
    """(id, mark, n_chars, n, next_id, next_mark): each document, its rows, and the next in descending order, after the last the first."""
    groups = cut(docs.groupBy("id", "mark").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("n")), "marks")
    ranges = min(MAX_RANGES, max(8, groups.count() // ORDER_ROWS))
    falling = (F.col("id").desc(), F.col("mark").desc())
    # Ranges are cut by id and mark, so texts that share an id may lie in several; they are written, so a range is fixed.
    groups = cut(groups.repartitionByRange(ranges, *falling).withColumn("range", F.spark_partition_id()), "ranges")
    tops = groups.groupBy("range").agg(F.max(F.struct("id", "mark")).alias("top"))
    over = Window.orderBy("range")  # one row per range
    tops = tops.select("range", F.coalesce(F.lead("top").over(over), F.max("top").over(Window.partitionBy())).alias("after"))
    next_ = F.coalesce(F.lead(F.struct("id", "mark")).over(Window.partitionBy("range").orderBy(*falling)), F.col("after"))
    with_next = groups.join(F.broadcast(tops), "range").withColumn("next", next_)  # at most MAX_RANGES rows
    return with_next.select("id", "mark", "n_chars", "n", F.col("next.id").alias("next_id"), F.col("next.mark").alias("next_mark"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """id, mark, n_chars, n, next_id, next_mark, text, edited of each document: the last third replaced by the start of the next."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), text.alias("text"))
    docs = docs.withColumn("mark", F.xxhash64("text"))
    order = cut(neighbours(docs.select("id", "mark", F.char_length("text").cast("long").alias("n_chars"))), "neighbours")
    used = order.select(
        F.col("next_id").alias("id"), F.col("next_mark").alias("mark"), F.col("id").alias("user_id"), F.col("mark").alias("user_mark"), F.floor(F.col("n_chars") / 3).cast("int").alias("take")
    )
    # Copies of a row fall together before the shuffle; both joins find the texts where the grouping leaves them.
    texts = docs.groupBy("id", "mark").agg(F.first("text").alias("text"))
    starts = texts.join(used.hint("merge"), ["id", "mark"]).select(F.col("user_id").alias("id"), F.col("user_mark").alias("mark"), F.substring("text", F.lit(1), F.col("take")).alias("start"))
    whole = texts.join(order.hint("merge"), ["id", "mark"]).join(starts.hint("merge"), ["id", "mark"])
    keep = (F.col("n_chars") - F.floor(F.col("n_chars") / 3)).cast("int")
    return whole.withColumn("edited", F.concat(F.substring("text", F.lit(1), keep), "start")).drop("start")


def compare(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    rows = with_fingerprint(with_fingerprint(edited_pairs(docs), "text", "a_"), "edited", "b_")
    rows = cut(rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("text", "edited"), "fingerprints")
    nexts = rows.select(F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("a_ids").alias("c_ids"), F.col("a_like").alias("c_like"), F.col("a_n").alias("c_n"))
    rows = rows.join(nexts, ["next_id", "next_mark"])
    for p in "abc":
        rows = rows.withColumn(f"{p}_print", fingerprint(F.col(f"{p}_ids"), F.col(f"{p}_like"), F.col(f"{p}_n"))).withColumn(f"{p}_signs", signs(F.col(f"{p}_like"), F.col(f"{p}_n")))
    near = {p: likeness(F.col("a_signs"), F.col(f"{p}_signs"), F.col("a_print") == F.col(f"{p}_print")) for p in "bc"}
    rows = rows.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", F.col("a_print").alias("fingerprint"),
        F.col("b_print").alias("edited_fingerprint"), near["b"].alias("near_edited"), near["c"].alias("near_next"), "n",
    )
    return rows.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
