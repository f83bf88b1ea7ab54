"""Near-duplicate documents by circulant MinHash with exact verification.

A text's set is that of its distinct shingles. Two permutations make all SIGNATURE
coordinates: the first scatters the shingles over a circle of CIRCLE places, the second
ranks the places and is shifted by one place for each next coordinate. Bands of the
signature name buckets. A pair of documents with similarity 0.8 shares no bucket with
probability (1 - 0.8**ROWS)**BANDS = 5e-8.

Documents with the same set are one class, named by its smallest id. Only links that
can still join two components are verified, on the full sets:

* while a bucket holds more than one component, some of its classes become hubs and meet
  its classes of other components. A hub has then met its whole bucket and leaves it. At
  first a bucket has one hub, then up to HUB_GROWTH times as many each round. No pair
  within a component is ever formed.
* a pair is formed only if its parity sketches allow a link. A sketch has a bit for each of
  PARITY places, flipped by every shingle that falls there, so two sketches differ in no
  more bits than the sets differ in shingles: no link is lost. This keeps out the many texts
  that share a passage or a template but not enough of it.

Each row gives an output row. A document without words has an empty set and is linked
with nothing, as is a row with a null id. Rows that share an id are one document in the
graph, with a set for each row. A very long text has all its shingles; beyond some thousand
its sketch is full and lets pairs pass that full sets then tell apart. A component is named
by its smallest id, so there are no ties. An empty table gives no rows. Extra columns are
ignored by near_duplicates() and kept by keep_one(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_names

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 32, 4
SIGNATURE = BANDS * ROWS
CIRCLE = 1 << 20
#: Words whose hash a worker keeps; bounds its memory.
KEPT_WORDS = 150_000
#: Shingles whose ranks are held at once.
CHUNK = 4096
HUB_GROWTH = 4
#: Bits of a parity sketch.
PARITY = 512

SIGNED = "doc_id long, n_shingles long, class binary, bands array<bigint>, parity array<bigint>"
LINKS = "a long, b long"


class WordHashes(dict):
    """64-bit hashes of words, the first KEPT_WORDS of them kept."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = h
        return h


_hashes = WordHashes()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of k words; with fewer words, of all of them as one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(k, len(h)), np.uint64)
    for at in range(min(k, len(h))):
        out = (out ^ h[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


@lru_cache(1)
def ranks() -> np.ndarray:
    """Row i: ranks of the places i, i + 1, ... of the circle, one for each coordinate."""
    order = np.random.RandomState(20).permutation(CIRCLE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: SIGNATURE - 1]]), SIGNATURE)


def signature(shingles: np.ndarray) -> np.ndarray:
    places = ((shingles * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) & (CIRCLE - 1)
    out = np.full(SIGNATURE, CIRCLE, np.uint32)
    for at in range(0, len(places), CHUNK):
        np.minimum(out, ranks()[places[at : at + CHUNK]].min(0), out=out)
    return out


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit name for each band of each signature."""
    parts = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), parts.shape[:2]).copy()
    for r in range(ROWS):
        out = (out ^ parts[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """PARITY bits, each the parity of the number of shingles that fall on it."""
    places = (shingles * np.uint64(0xA24BAED4963EE407)) >> np.uint64(64 - PARITY.bit_length() + 1)
    odd = np.bincount(places.astype(np.int64), minlength=PARITY).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def class_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(shingles.tobytes())


def signed(docs: DataFrame, k: int) -> DataFrame:
    """Set size, class and bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                sets = [shingle_set(t, k) for t in b.column("text").to_pylist()]
                some = np.array([len(s) > 0 for s in sets])
                bands = iter(band_hashes(np.stack([signature(s) for s in sets if len(s)])).tolist() if some.any() else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id"),
                        pa.array(map(len, sets), pa.int64()),
                        pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(bands) if s else None for s in some], pa.list_(pa.int64())),
                        pa.array([parity(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "class", "bands", "parity"],
                )

    return docs.mapInArrow(run, SIGNED)


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; texts: doc_id, text."""
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    rows = pairs.select("a", "b").join(b.hint("merge"), "b").join(a.hint("merge"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                text = batch.column("a_text")[i].as_py()
                if text != last:  # rows come ordered by a
                    last, kept = text, shingle_set(text, k)
                other = shingle_set(batch.column("b_text")[i].as_py(), k)
                both = len(np.intersect1d(kept, other, assume_unique=True))
                found.append(100 * both >= percent * (len(kept) + len(other) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(found, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    return rows.mapInArrow(run, LINKS).distinct()


def components(links: DataFrame) -> DataFrame:
    """(v, c): the smallest vertex reachable from each vertex of the links (a, b)."""
    edges = cut(links.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(links.select(F.col("b").alias("v"), F.col("a").alias("w"))).distinct(), "edges")
    labels = cut(edges.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("c")), "labels")
    while True:
        near = edges.join(labels.select(F.col("v").alias("w"), "c"), "w").groupBy("v").agg(F.min("c").alias("near"))
        step = labels.join(near, "v").select("v", F.least("c", "near").alias("c"), F.col("c").alias("was"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("further"))
        step = cut(step.join(jump, "c").select("v", F.least("c", "further").alias("c"), (F.least("c", "further") < F.col("was")).alias("moved")), "labels")
        labels = step.select("v", "c")
        if step.where("moved").isEmpty():
            return labels


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """comp (rep, c) with the components of the links (a, b) joined."""
    by = comp.select(F.col("rep").alias("a"), F.col("c").alias("ca"))
    ends = links.join(by, "a").join(by.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b")
    new = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b").distinct())
    return cut(comp.join(new.select(F.col("v").alias("c"), F.col("c").alias("to")), "c", "left").select("rep", F.coalesce("to", "c").alias("c")), "components")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = cut(signed(docs, k), "signatures")
    some = rows.where(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    classes = cut(some.groupBy("class").agg(F.min("doc_id").alias("rep")), "classes")
    members = some.join(classes.withColumnRenamed("rep", "doc_id"), ["class", "doc_id"]).withColumnsRenamed({"doc_id": "rep", "n_shingles": "n"}).withColumn("set", F.xxhash64("class"))
    bands = members.select("rep", "set", "n", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most").select("band")
    buckets = cut(bands.join(shared, "band").select("band", "rep", "set", "n").distinct(), "buckets")
    comp = cut(buckets.select("rep").distinct().withColumn("c", F.col("rep")), "components")
    texts = cut(docs.join(comp.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id"), "texts")
    # The members that share a bucket with another class, with what tells whether they may be linked.
    members = cut(members.join(comp.select("rep"), "rep").select("rep", "set", "parity").dropDuplicates(["rep", "set"]), "members")

    def may_link() -> Column:
        n, m = F.col("n"), F.col("hub_n")
        differ = reduce(lambda x, y: x + y, (F.bit_count(F.get("parity", F.lit(k)).bitwiseXOR(F.get("hub_parity", F.lit(k)))) for k in range(PARITY // 64)))
        # Similarity p per cent means that the sets differ in at most (100 - p) / (100 + p) of their summed sizes.
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * differ <= (100 - percent) * (n + m))

    tested = None
    hubs = 1
    while True:
        held = buckets.join(comp, "rep")
        open_ = held.groupBy("band").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("band")
        held = cut(held.join(open_, "band"), "held")
        if held.isEmpty():
            break
        slot = F.pmod(F.xxhash64("rep", F.lit(hubs)), F.lit(hubs))
        hub = cut(held.groupBy("band", slot.alias("slot")).agg(F.min(F.struct("rep", "set", "n", "c")).alias("hub")).select("band", "hub.*"), "hubs")
        told = members.join(held.select("rep").distinct(), "rep")
        left = held.join(told, ["rep", "set"])
        right = hub.join(told, ["rep", "set"]).select("band", *(F.col(x).alias(f"hub_{x}") for x in ("rep", "n", "c", "parity")))
        met = left.join(right, "band").where((F.col("c") != F.col("hub_c")) & may_link())
        pairs = met.select(F.least("rep", "hub_rep").alias("a"), F.greatest("rep", "hub_rep").alias("b")).distinct()
        pairs = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            tested = pairs if tested is None else tested.unionByName(pairs)
            links = cut(verified(pairs, texts, k, percent), "links")
            if not links.isEmpty():
                comp = merged(comp, links)
        buckets = held.drop("c").join(hub.select("band", "rep", "set"), ["band", "rep", "set"], "left_anti")
        hubs *= HUB_GROWTH
    named = classes.join(comp, "rep", "left").select("class", F.coalesce("c", "rep").alias("component_id"))
    named = cut(named, "named-classes")
    out = rows.select("doc_id", "n_shingles", "class").join(named, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs without the rows whose document is linked, directly or through others, to one of a smaller id."""
    (name,) = free_names(docs, "gone")
    gone = cut(near_duplicates(docs, k, percent).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct(), "near-copies")
    return docs.join(gone.hint("merge"), F.col("doc_id") == F.col(name), "left_anti")


#: DuckDB SQL for near_duplicates over documents with shingles of 4 words. It meets all pairs that share a shingle.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
n AS (SELECT doc_id, len(s) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(d, x) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.d, e.b FROM r JOIN e ON r.x = e.a)
SELECT n.doc_id, n.n AS n_shingles, min(x) AS component_id, n.doc_id = min(x) AS kept FROM n JOIN r ON r.d = n.doc_id GROUP BY n.doc_id, n.n
"""
