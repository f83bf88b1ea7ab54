"""Spelling variants among a corpus's words, by pivotal grams.

Words are the corpus's runs of ASCII and Latin-1 letters, A-Z lower-cased; a run drawn by a hash of its document's id
and its letters loses one letter. Words of at least min_length code points that occur at least min_count times take
part. Two of them are near if one inserted, deleted or replaced code point turns one into the other.

Bigrams are ranked from rare to frequent over the words. A word's prefix holds its three rarest bigrams and all that tie
with the third. Of the prefix, dynamic programming picks two disjoint bigrams with the least total frequency, the
pivots. Of two near words, take the one whose last prefix bigram is the rarer as first: one edit spares one of its two
pivots, the left one if the edit lies right of it, else the right one, and a spared pivot is in the other word's prefix
at a place that the edit moves by one at most. All letters on the pivot's far side from the edit are spared too, and
of the near side one half, so the index is keyed by the pivot's place, the other word's length and all letters
that must be spared: at least half the word. Words that meet under a key are verified by edit distance. Keys are
hashes of letters; every pair of near words meets, and no bucket is capped. Joins are merged: Spark takes the index, dozens
of rows a word, and the packed files of words for far smaller than they are in memory, and would send them through the driver.

A null or empty text has no words, a very long one is read whole; a null id hashes like an empty one. Repeated rows count
as often as they are there. Of near words with equal counts the smallest in code-point order is the form. Forms at least
double the count, so chains end. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT = 5, 3
#: One run in so many loses a letter.
DAMAGE = 97
#: A form occurs at least so many times as often.
FACTOR = 2
PREFIX = 3


def counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words after the damage."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    run = run.select("id", ascii_lower(F.col("run")).alias("run"))
    run = run.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return run.select(F.when(F.col("h") % DAMAGE == 0, shorter).otherwise(F.col("run")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def ranks(words: DataFrame) -> dict[str, int]:
    """Rank of every bigram by frequency, then letters. There are 90 letters, so 8,100 bigrams at most."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda k: F.substring("word", k, F.lit(2)))).alias("gram"))
    found = sorted((r["n"], r["gram"]) for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect())
    return {gram: k for k, (_, gram) in enumerate(found)}


def prefix_and_pivots(word: str, rank: dict[str, int]) -> tuple[list[int], int, int, int]:
    """Places of the prefix's bigrams, the last one's rank, and the places of the two pivots.

    Frequencies rise with ranks, so the pivots' cost is the sum of ranks.
    """
    grams = [rank[word[k : k + 2]] for k in range(len(word) - 1)]
    last = sorted(grams)[PREFIX - 1]
    prefix = [k for k, g in enumerate(grams) if g <= last]
    best = left = right = None  # of pairs; the cheapest single bigram that ends before the current one
    single: list[tuple[int, int]] = []  # cheapest of the first so many prefix bigrams
    before = 0
    for number, k in enumerate(prefix):
        while before < number and prefix[before] <= k - 2:
            before += 1
        if before and (best is None or single[before - 1][0] + grams[k] < best):
            best, left, right = single[before - 1][0] + grams[k], single[before - 1][1], k
        here = (grams[k], k)
        single.append(min(single[-1], here) if single else here)
    return prefix, last, left, right


def keys_right(word: str, place: int, length: int) -> Iterator[str]:
    """Keys for an edit right of the bigram at place; length is the other word's."""
    shift, middle = len(word) - length, place + 2 + (length - place - 2) // 2
    yield f"0{length},{place},{word[:middle]}"
    yield f"1{length},{place},{word[: place + 2]},{word[max(middle + shift, 0) :]}"


def keys_left(word: str, place: int, length: int) -> Iterator[str]:
    """Keys for an edit left of the bigram at place; length is the other word's."""
    shift = len(word) - length
    there = place - shift  # place in the other word
    middle = there // 2
    yield f"2{length},{there},{word[:middle]},{word[place:]}"
    yield f"3{length},{there},{word[max(middle + shift, 0) :]}"


def pivot_keys(word: str, left: int, right: int) -> set[str]:
    out = set()
    for length in (len(word) - 1, len(word), len(word) + 1):
        out.update(keys_right(word, left, length))
        if right - len(word) + length >= 0:
            out.update(keys_left(word, right, length))
    return out


def prefix_keys(word: str, prefix: list[int]) -> set[str]:
    return {key for place in prefix for keys in (keys_right, keys_left) for key in keys(word, place, len(word))}


def index(words: DataFrame, rank: dict[str, int]) -> DataFrame:
    """(key, word, last, pivot) of every word, as pivots and as prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 2000):
                keys, names, lasts, kinds = [], [], [], []
                for word in b.column("word").slice(start, 2000).to_pylist():
                    prefix, last, left, right = prefix_and_pivots(word, rank)
                    for pivot, found in ((True, pivot_keys(word, left, right)), (False, prefix_keys(word, prefix))):
                        keys += [xxhash.xxh64_intdigest(k) - (1 << 63) for k in found]
                        names += [word] * len(found)
                        lasts += [last] * len(found)
                        kinds += [pivot] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.string()), pa.array(lasts, pa.int32()), pa.array(kinds, pa.bool_())], ["key", "word", "last", "pivot"])

    return words.select("word").mapInArrow(run, "key long, word string, last int, pivot boolean")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of near words, once each."""
    rows = index(words, ranks(words))
    first = rows.where("pivot").select("key", F.col("word").alias("x"), F.col("last").alias("x_last"))
    other = rows.where("NOT pivot").select("key", F.col("word").alias("y"), F.col("last").alias("y_last"))
    met = first.join(other.hint("merge"), "key").where("x_last <= y_last AND x <> y AND levenshtein(x, y, 1) = 1")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def with_roots(links: DataFrame) -> DataFrame:
    """(word, root) of words with a form: forms are followed to the last by doubling steps."""
    links = cut(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = cut(links.join(on.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        links = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that takes part; min_length is 5 at least."""
    words = cut(counts(docs).where((F.char_length("word") >= min_length) & (F.col("n") >= min_count)), "words")
    pairs = cut(near_words(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    near = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge"), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    out = words.join(best.hint("merge"), "word", "left").withColumn("formed", F.col("n") * FACTOR <= -F.col("best.less"))
    out = cut(
        out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("formed"), F.col("best.near")).alias("form"), F.when(F.col("formed"), -F.col("best.less")).alias("form_n")),
        "word-forms",
    )
    roots = with_roots(out.where("form IS NOT NULL"))
    return out.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: DuckDB SQL for variants over documents: CRC-32 by its table of 256 steps, near words by the letters they lose.
SQL = r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
held AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (SELECT held.*, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM held),
hashed AS (SELECT doc_id, run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(b, lambda x: x::BIGINT)), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n FROM hashed GROUP BY 1),
w AS (SELECT word, n FROM words WHERE length(word) >= 5 AND n >= 3),
cuts AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT w.word, c.word, c.n FROM w JOIN cuts c ON w.word = c.rest
  UNION SELECT c.word, w.word, w.n FROM w JOIN cuts c ON w.word = c.rest),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM near GROUP BY word),
form AS (SELECT best.*, (SELECT min(near) FROM near WHERE near.word = best.word AND near.near_n = best.near_n) AS near FROM best),
o AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM w LEFT JOIN form ON w.word = form.word),
chain(word, here, depth) AS (SELECT word, word, 0 FROM o UNION ALL SELECT chain.word, o.form, depth + 1 FROM chain JOIN o ON o.word = chain.here WHERE o.form IS NOT NULL),
root AS (SELECT word, arg_max(here, depth) AS root FROM chain GROUP BY word)
SELECT o.word, form, root, n, n_near, form_n FROM o JOIN root ON o.word = root.word
"""
