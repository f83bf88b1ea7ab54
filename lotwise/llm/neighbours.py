"""Nearest neighbours by a block matrix join with int8 product tiles.

Vectors are packed into blocks and quantised to int8 once, with one scale per vector. A
group of queries and a few blocks of candidates make a cell of a grid. In a cell the
product of the code matrices gives every inner product with an error bound from the
residual norms. A pair survives if its upper bound reaches the k-th best lower bound of
its query, first in its cell, then over all cells. Only codes and bounds go through the
grid; the vectors of surviving pairs are fetched by row, their products recomputed in
double precision, and the best kept by a heap per query.

Each query group meets each candidate block once. A cell holds one group and a few
blocks, so its memory does not grow with the input. A group has a QUERY_GROUPS-th of the
queries up to MOST_QUERIES, so candidates are sent QUERY_GROUPS times at most while there
are fewer than QUERY_GROUPS * MOST_QUERIES queries. Of equal vectors in a cell only the
k + 1 of the smallest ids are met: the others could not be among the k nearest of any
query. Vectors that differ by less than int8 codes can tell all survive.

Vectors that are null, zero or hold a null or non-finite component take no part.
Only vectors of the query's own dimension are candidates. Equal scores go to the
smaller vec_id. Every row is a candidate and, by its id, a query of its own, so rows that
share a vec_id each get their neighbours, the other rows of the id among them. An empty
table gives no rows. Extra columns are ignored. Results are exact, so recall is 1.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

K, EVERY = 20, 20
CANDIDATE_BLOCK = 2048
#: Candidate blocks a cell of the grid meets, on average.
COLUMN_BLOCKS = 8
#: Groups that queries are dealt to, and the bounds of their size.
QUERY_GROUPS, LEAST_QUERIES, MOST_QUERIES = 32, 1024, 131_072
#: Queries and candidates of one tile.
TILE = (512, 2048)
#: Components whose int8 products sum exactly in a float32.
EXACT = 1024
#: Bits of a row's place in its block, and of a block's number in its task.
PLACE = 16
BLOCK = "block long, dim int, n int, ids binary, codes binary, scales binary, norms binary, errors binary, marks binary, vectors binary"
QUERY = "row long, query_id long, dim int, code binary, scale double, norm double, error double"
MET = "row long, query_id long, other long, vec_id long, low double, high double"
FOUND = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, v of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull())
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors and of the residuals."""
    scale = np.abs(m).max(1) / 127
    codes = np.rint(m / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.sqrt((decoded**2).sum(1)), np.sqrt(((m - decoded) ** 2).sum(1))


def blocks(rows: DataFrame, size: int, single: bool) -> DataFrame:
    """Rows of one dimension packed by so many: ids, int8 codes with their bounds, marks of equal vectors, and the vectors (single: as float32)."""
    kind = "<f4" if single else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        made = TaskContext.get().partitionId() << PLACE

        def out(dim: int, ids: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
            nonlocal made
            marks = b"".join(xxhash.xxh64_digest(v.tobytes()) for v in m + 0.0)
            values = [made, dim, len(ids), ids.tobytes(), *(a.tobytes() for a in quantise(m)), marks, m.astype(kind).tobytes()]
            made += 1
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 7]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], [f.split()[0] for f in BLOCK.split(", ")])

        for b in batches:
            ids, lists = b.column("vec_id").to_numpy(), b.column("v")
            dims, values = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            starts = np.concatenate(([0], np.cumsum(dims)))[:-1]
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                m = values[(starts[at][:, None] + np.arange(dim))] if len(at) < len(dims) else values.reshape(-1, dim)
                old = held.pop(int(dim), [])
                new_ids, new_m = np.concatenate([*(x for x, _ in old), ids[at].astype("<i8")]), np.concatenate([*(x for _, x in old), m])
                full = len(new_ids) // size * size
                for k in range(0, full, size):
                    yield out(int(dim), new_ids[k : k + size], new_m[k : k + size])
                if full < len(new_ids):
                    held[int(dim)] = [(new_ids[full:], new_m[full:])]
        for dim, ((ids, m),) in held.items():
            yield out(dim, ids, m)

    return rows.select("vec_id", "v").mapInArrow(run, BLOCK)


def queries_of(candidates: DataFrame, every: int) -> DataFrame:
    """The queries among the rows of blocks, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                ids = np.frombuffer(x["ids"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                codes = np.frombuffer(x["codes"], np.int8).reshape(len(ids), -1)[at]
                numbers = [pa.array(np.frombuffer(x[c], "<f8")[at]) for c in ("scales", "norms", "errors")]
                first = [pa.array((x["block"] << PLACE) + at), pa.array(ids[at]), pa.array(np.full(len(at), x["dim"], np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())]
                yield pa.RecordBatch.from_arrays([*first, *numbers], ["row", "query_id", "dim", "code", "scale", "norm", "error"])

    return candidates.select("block", "dim", "ids", "codes", "scales", "norms", "errors").mapInArrow(run, QUERY)


def rows_of(candidates: DataFrame) -> DataFrame:
    """row and vector of every row of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.to_pylist():
                width = len(x["vectors"]) // x["n"]
                vectors = [x["vectors"][k : k + width] for k in range(0, len(x["vectors"]), width)]
                yield pa.RecordBatch.from_arrays([pa.array((x["block"] << PLACE) + np.arange(x["n"])), pa.array(vectors, pa.binary())], ["row", "vector"])

    return candidates.select("block", "n", "vectors").mapInArrow(run, "row long, vector binary")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: float32 multiplies hold sums of up to EXACT of them without rounding."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT):
        out += a[:, k : k + EXACT].astype(np.float32) @ b[:, k : k + EXACT].astype(np.float32).T
    return out


def first_of_equals(marks: np.ndarray, ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Places of the rows that are among the so many of the smallest (id, row) of their mark."""
    order = np.lexsort((rows, ids, marks))
    sorted_marks = marks[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_marks[1:] != sorted_marks[:-1])))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return np.sort(order[rank < most])


def meet(queries: tuple, candidates: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Surviving pairs as places of queries and candidates, with their bounds. Both sides: rows, codes, scales, norms, errors."""
    rows, codes, scales, norms, errors = queries
    found = []
    for a in range(0, len(rows), TILE[0]):
        q = slice(a, a + TILE[0])
        best, kept = np.full((len(rows[q]), k), -np.inf), []
        for b in range(0, len(candidates[0]), TILE[1]):
            c_rows, c_codes, c_scales, c_norms, c_errors = (x[b : b + TILE[1]] for x in candidates)
            about = products(codes[q], c_codes) * scales[q, None] * c_scales
            bound = (errors[q, None] * c_norms + norms[q, None] * c_errors + errors[q, None] * c_errors) * (1 + 1e-9) + 1e-12 * (norms[q] + errors[q])[:, None] * (c_norms + c_errors)
            low, high = about - bound, about + bound
            own = rows[q, None] == c_rows  # a query is no candidate of its own
            low[own] = high[own] = -np.inf
            best = np.partition(np.hstack([best, low]), -k, 1)[:, -k:]
            i, j = np.nonzero((high >= best.min(1)[:, None]) & ~own)
            kept.append((i, j + b, low[i, j], high[i, j]))
        i, j, low, high = (np.concatenate(x) for x in zip(*kept, strict=True))
        stays = high >= best.min(1)[i]
        found.append((i[stays] + a, j[stays], low[stays], high[stays]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def cell(k: int):
    """What one group of queries and the candidate blocks of one column leave over."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in MET.split(", ")]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in [pa.int64()] * 4 + [pa.float64()] * 2], names)

        def flat(column: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(right.column(column).to_pylist()), kind)

        dim = left.column("dim")[0].as_py()
        sizes = right.column("n").to_numpy()
        rows = (np.repeat(right.column("block").to_numpy(), sizes) << PLACE) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = flat("ids", "<i8")
        use = first_of_equals(flat("marks", "<i8"), ids, rows, k + 1)
        candidates = (rows[use], flat("codes", "i1").reshape(-1, dim)[use], *(flat(c, "<f8")[use] for c in ("scales", "norms", "errors")))
        codes = np.frombuffer(b"".join(left.column("code").to_pylist()), "i1").reshape(-1, dim)
        queries = (left.column("row").to_numpy(), codes, *(left.column(c).to_numpy() for c in ("scale", "norm", "error")))
        i, j, low, high = meet(queries, candidates, k)
        return pa.table([pa.array(x) for x in (queries[0][i], left.column("query_id").to_numpy()[i], candidates[0][j], ids[use][j], low, high)], names)

    return run


def nearest(vectors: DataFrame, every: int = EVERY, k: int = K, candidate_block: int = CANDIDATE_BLOCK, least_queries: int = LEAST_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every vector whose id is divisible by every."""
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    candidates = cut(blocks(usable(vectors), candidate_block, single), "candidate-blocks")
    queries = cut(queries_of(candidates, every), "queries")
    n = queries.count()
    groups = -(-n // max(least_queries, min(MOST_QUERIES, n // QUERY_GROUPS))) or 1
    columns = max(1, -(-candidates.count() // COLUMN_BLOCKS))
    keys = ["dim", "group", "column"]
    left = queries.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")).withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = candidates.drop("vectors").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("column", F.pmod(F.xxhash64("block"), F.lit(columns)).cast("int"))
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell(k), MET)
    by_low = F.row_number().over(Window.partitionBy("row").orderBy(F.col("low").desc()))
    floor = F.max(F.when(F.col("at") == k, F.col("low"))).over(Window.partitionBy("row"))
    pairs = met.withColumn("at", by_low).withColumn("floor", floor).where("floor IS NULL OR high >= floor").select("row", "query_id", "other", "vec_id")
    of = rows_of(candidates)
    pairs = pairs.join(of.select(F.col("row").alias("other"), F.col("vector").alias("c")), "other").join(of.select("row", F.col("vector").alias("q")), "row")
    kind = "<f4" if single else "<f8"

    def best(t: pa.Table) -> pa.Table:
        q = np.frombuffer(t.column("q")[0].as_py(), kind).astype(float)
        c = np.frombuffer(b"".join(t.column("c").to_pylist()), kind).reshape(-1, len(q)).astype(float)
        scores = np.add.accumulate(c * q, 1)[:, -1]  # summed in order: equal vectors score equally
        heap = heapq.nlargest(k, zip(scores.tolist(), (-t.column("vec_id").to_numpy()).tolist(), strict=True))
        query = t.column("query_id")[0].as_py()
        columns = ([query] * len(heap), range(1, len(heap) + 1), [-v for _, v in heap], [s for s, _ in heap])
        return pa.table([pa.array(x, kind) for x, kind in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], ["query_id", "rank", "vec_id", "score"])

    return pairs.groupBy("row").applyInArrow(best, FOUND)


#: DuckDB SQL for nearest over embeddings.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
  FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
