"""Snapshot bodies of any size: one root object or array is cut over many tasks.

A file is read in byte ranges as texts that end at a closing brace. One pass joins a range's texts to chunks; for every chunk
its quotes, and its brackets outside strings, are counted as if it began outside and as if it began inside a string; sums
over the chunks of a file tell how each really begins and how deep it lies. A chunk is cut behind its first brace that
ends a value of the root, so pieces hold whole values, are about a chunk long and are parsed by themselves.

A body that cannot be read as a whole gives no rows and one error: empty, no_object_or_array, cut_off (ended inside a
string or bracket), unreadable. Files are plain UTF-8; compressed ones are not_plain.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.tables import written

CHUNK = 1 << 20
MESSAGES = {
    "empty": "the file has no content", "no_object_or_array": "the root is no object and no array", "cut_off": "the body ends inside a string or bracket",
    "unreadable": "a part of the body is no JSON", "not_plain": "the file is compressed or no plain text",
}


#: Byte ranges that a task reads where there are many.
RANGES = 16
#: Chunks that Python gets at once.
CHUNKS_AT_ONCE = 32
#: What each byte adds to the depth, outside strings.
STEP = np.zeros(256, np.int8)
STEP[list(b"{[")], STEP[list(b"}]")] = 1, -1
#: A backslash and what it escapes; texts end before a brace, so none is escaped.
ESCAPED = re.compile(rb"\\[^}]")


@contextmanager
def settings(spark: SparkSession, names: dict[str, str]) -> Iterator[None]:
    """Session settings for what is written inside."""
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def blocks(size: int | None) -> dict[str, str]:
    """Files are split at so many bytes."""
    return {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"} if size else {}


def structure(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What each byte adds to the depth, and whether it lies inside a string (1 or 0), if the text begins outside; the other way round if it begins inside."""
    clean = np.frombuffer(ESCAPED.sub(b"__", text), np.uint8)
    return STEP[clean], (np.cumsum(clean == ord('"')) & 1).astype(np.int8)


def first_end(text: bytes, begun: int, base: int) -> int:
    """Where a text's first value of the root has ended, behind its brace; 0 if none does."""
    length = 1 << 12
    while True:
        step, inside = structure(text[:length])
        outside = inside == begun
        ends = np.flatnonzero((np.cumsum(np.where(outside, step, 0)) + base == 1) & outside & (np.frombuffer(text, np.uint8, len(step)) == ord("}")))
        if len(ends):
            return int(ends[0]) + 1
        if length >= len(text):
            return 0
        length *= 8


def gathered(chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins the texts of a byte range, in their order, to chunks with their braces: a chunk holds the texts that begin in its bytes."""

    def made(file: int, block: int, number: int, parts: list[bytes]) -> pa.RecordBatch:
        text = b"".join(parts)
        step, inside = structure(text)
        within = int(np.sum(step * inside, dtype=np.int64))
        row = [file, block, number, len(text), int(inside[-1]), int(np.sum(step, dtype=np.int64)) - within, within]
        return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in row), pa.array([text], pa.binary()).view(pa.string())], ["file", "block", "chunk", "size", "odd", "e0", "e1", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at, parts = None, 0, []  # file, block and chunk that parts belong to, and the bytes of the range before
        for b in batches:
            if not b.num_rows:
                continue
            file, block = (b.column(c).to_numpy() for c in ("file", "block"))
            texts = b.column("text").view(pa.binary())
            size = pc.binary_length(texts).to_numpy().astype(np.int64) + 1
            new = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
            for start, stop in zip([0, *new], [*new, b.num_rows]):
                if here is None or here[:2] != (file[start], block[start]):
                    if parts:
                        yield made(*here, parts)
                    here, at, parts = (file[start], block[start], 0), 0, []
                past = at + np.cumsum(size[start:stop])
                number = (past - size[start:stop]) // chunk
                at = int(past[-1])
                cuts = np.flatnonzero(np.diff(number)) + 1
                for i, j in zip([0, *cuts], [*cuts, stop - start]):
                    if number[i] != here[2]:
                        if parts:
                            yield made(*here, parts)
                        here, parts = (*here[:2], int(number[i])), []
                    one = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), texts.slice(start + i, j - i))
                    parts += [pc.binary_join(one, pa.scalar(b"}"))[0].as_py(), b"}"]
        if parts:
            yield made(*here, parts)

    return run


def chunks_of(spark: SparkSession, paths: str | list[str], chunk: int = CHUNK) -> DataFrame:
    """file (a hash of the path), block, chunk, size, odd (the chunk holds an odd number of quotes), e0 and e1 (its depth, begun outside and inside a string), text."""
    raw = spark.read.option("lineSep", "}").text(paths)
    rows = raw.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))
    # A task reads several byte ranges, one after the other.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions() // RANGES)
    return rows.coalesce(tasks).mapInArrow(gathered(chunk), "file long, block long, chunk long, size long, odd long, e0 long, e1 long, text string")


def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two texts of a chunk: up to its first end of a value of the root, and behind it."""
    for b in batches:
        texts = b.column("text").view(pa.binary())
        out = {"file": [], "number": [], "head": [], "text": [], "last": []}
        for file, number, begun, base, last, unclosed, text in zip(*(b.column(c).to_pylist() for c in ("file", "number", "begun", "base", "last", "unclosed")), texts):
            text = text.as_py()[:-1] if unclosed else text.as_py()
            cut = first_end(text, begun, base)
            parts = [(True, text[:cut]), (False, text[cut:])] if cut else [(True, text)]
            for head, part in parts:
                if part or not cut:
                    values = (file, number, head, part, last and (not head or cut in (0, len(text))))
                    for column, value in zip(out.values(), values):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.bool_()]
        columns = [pa.array(v, t) for v, t in zip(out.values(), kinds)]
        columns[3] = columns[3].view(pa.string())
        yield pa.RecordBatch.from_arrays(columns, list(out))


def cut_bodies(spark: SparkSession, paths: str | list[str], block: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """path, file_name, piece, body, code of all files: bodies of whole values of the root, or one piece with an error code for a file that has none.

    block is the number of bytes of a file that a task reads, the session's spark.sql.files.maxPartitionBytes without it.
    """
    with settings(spark, blocks(block)):
        chunks = written(chunks_of(spark, paths, chunk), "chunks")
    names = {"path": "file_path", "file_name": "file_name", "file_size": "file_size"}
    files = spark.read.format("binaryFile").load(paths).select(*(F.col(f"_metadata.{v}").alias(k) for k, v in names.items())).distinct()
    one = F.when(F.count("*") > 1, F.raise_error(F.lit("two paths have one hash")).cast("string")).otherwise(F.max("path"))
    files = written(files.groupBy(F.xxhash64("path").alias("file")).agg(one.alias("path"), F.max("file_name").alias("file_name"), F.max("file_size").alias("file_size")), "files")
    here = ["file", "block", "chunk"]
    order = Window.partitionBy("file").orderBy("block", "chunk")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.drop("text").withColumns({"begun": F.coalesce(F.sum("odd").over(past) % 2, F.lit(0)), "number": F.row_number().over(order).cast("long"), "last": F.lead("block").over(order).isNull()})
    places = places.withColumn("base", F.coalesce(F.sum(F.expr("IF(begun = 0, e0, e1)")).over(past), F.lit(0)))
    places = places.withColumns({"depth": F.expr("base + IF(begun = 0, e0, e1)"), "inside": F.expr("(begun + odd) % 2 = 1")})
    sizes = chunks.groupBy("file").agg(F.sum("size").alias("size")).join(files, "file").select("file", (F.col("file_size") - F.col("size")).alias("spare"))
    # The last text of a file has no brace behind it, unless the file's size says that one is there.
    places = written(places.join(sizes, "file").withColumn("unclosed", F.expr("last AND spare <> 0")), "places")
    # Without its brace the last text is a level deeper than was counted, if it ended outside a string.
    ends = places.where("last").select("file", "spare", F.struct(F.expr("IF(unclosed AND NOT inside, depth + 1, depth)").alias("depth"), "inside").alias("end"))
    ends = written(files.join(ends, "file"), "ends")
    found = chunks.select(*here, "text").join(places.select(*here, "number", "begun", "base", "last", "unclosed"), here).drop("block", "chunk")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(CHUNKS_AT_ONCE)}):
        parts = written(found.mapInArrow(halves, "file long, number long, head boolean, text string, last boolean"), "parts")
    # What stands before a chunk's first end belongs to the piece that the last chunk with an end has begun.
    cuts = parts.groupBy("file", "number").agg(F.bool_or(~F.col("head")).alias("own"))
    begun = F.last(F.when(F.col("own"), F.col("number")), ignorenulls=True).over(Window.partitionBy("file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    earlier = cuts.select("file", "number", F.coalesce(begun, F.lit(0).cast("long")).alias("piece"))
    rows = parts.where("head").join(earlier, ["file", "number"]).unionByName(parts.where("NOT head").withColumn("piece", F.col("number")))
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "piece")  # so small bodies are not gathered into one task
    pieces = rows.groupBy("file", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "text"))), lambda t: t["text"]), "").alias("text"), F.max("last").alias("last"))
    pieces = pieces.join(ends, "file").select("path", "piece", "text", "last", "spare", "end")
    return _checked(written(pieces, "pieces"), ends.select("path", "file_name"), listed(spark, paths))


def listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, file_name of all files. Scans pass over files without a byte; the scan's own list of files has them."""
    found = [re.sub("^file:/+", "file:/", p) for p in spark.read.text(paths).inputFiles()]
    return spark.createDataFrame([(p, unquote(p.rsplit("/", 1)[-1])) for p in found], "path string, file_name string")


def _checked(pieces: DataFrame, names: DataFrame, every: DataFrame) -> DataFrame:
    # Tables of a row a file are written, so that Spark knows how small they are and does not deal bodies out by file.
    first = written(pieces.where("piece = 0").select("path", F.left(F.regexp_replace("text", r"^\s+", ""), F.lit(1)).alias("root")), "roots")
    rows = pieces.join(first, "path")
    inner = F.when(F.col("piece") == 0, F.regexp_replace("text", r"^\s*[\[{]", "")).otherwise(F.regexp_replace("text", r"^\s*,", ""))
    close = F.when(F.col("root") == "{", "}").otherwise("]")
    tail = F.regexp_replace("text", r"\s+$", "")
    inner = F.when(F.col("last"), F.regexp_replace(inner, r"\s*[\]}]\s*$", "")).otherwise(inner)
    rows = rows.withColumns({"inner": inner, "body": F.concat("root", inner, close)})
    comma = F.col("text").rlike(r"^\s*,")
    blank = F.col("inner").rlike(r"^\s*$")
    joined = (F.col("piece") == 0) | F.when(comma, ~blank).otherwise(F.col("last") & blank)
    shape = joined & (~F.col("last") | (F.right(tail, F.lit(1)) == close))
    parsed = F.when(F.col("root") == "{", F.from_json("body", "map<string,variant>").isNotNull()).otherwise(F.from_json("body", "array<variant>").isNotNull())
    code = (
        F.when(~F.col("spare").isin(0, -1), "not_plain").when(F.col("root") == "", "empty").when(~F.col("root").isin("{", "["), "no_object_or_array")
        .when(F.col("last") & ((F.col("end.depth") > 0) | F.col("end.inside")), "cut_off").when(~(shape & parsed), "unreadable")
    )
    rows = written(rows.select("path", "piece", "body", code.alias("code")), "bodies")
    bad = rows.where("code IS NOT NULL").groupBy("path").agg(F.array_min(F.collect_set(_rank(F.col("code")))).alias("worst"))
    bad = written(bad.select("path", F.get(F.array(*map(F.lit, MESSAGES)), F.col("worst")).alias("code")), "bad")
    empty = every.join(names, "path", "left_anti").select("path", "file_name", F.lit(0).cast("long").alias("piece"), F.lit(None).cast("string").alias("body"), F.lit("empty").alias("code"))
    good = rows.drop("code").join(bad, "path", "left_anti").withColumn("code", F.lit(None).cast("string"))
    failed = bad.select("path", F.lit(0).cast("long").alias("piece"), F.lit(None).cast("string").alias("body"), "code")
    return good.unionByName(failed).join(names, "path").select("path", "file_name", "piece", "body", "code").unionByName(empty)


def _rank(code: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MESSAGES)), code).cast("int") - 1


def errors(pieces: DataFrame) -> DataFrame:
    """path, file_name, code, message of the files that could not be read."""
    message = F.element_at(F.create_map(*(F.lit(x) for kv in MESSAGES.items() for x in kv)), F.col("code"))
    return pieces.where("code IS NOT NULL").select("path", "file_name", "code", message.alias("message"))


def values(pieces: DataFrame) -> DataFrame:
    """path, file_name, key, piece, pos, raw of the readable files: one row per value of the root in order of (piece, pos); of equal keys the last stays."""
    root = F.left("body", F.lit(1))
    by_key = F.transform(F.map_entries(F.from_json("body", "map<string,variant>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("raw")))
    items = F.transform(F.from_json("body", "array<variant>"), lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("raw")))
    rows = pieces.where("code IS NULL").select("path", "file_name", "piece", F.posexplode(F.when(root == "{", by_key).otherwise(items)).alias("pos", "item"))
    rows = rows.select("path", "file_name", "piece", "pos", "item.key", "item.raw")
    # Only keys go to the shuffle that finds repeated ones; as a rule there are none, and the rows stay where they are.
    place = F.shiftleft("piece", 31) + F.col("pos")
    file = [F.xxhash64("path").alias("file"), F.crc32(F.col("path").cast("binary")).alias("check")]  # instead of a long path a row
    again = rows.where("key IS NOT NULL").groupBy("key", *file).agg(F.count("*").alias("times"), F.max(place).alias("kept")).where("times > 1")
    lost = again.select("key", "file", "check", "kept")
    out = rows.select("*", *file).join(lost, ["key", "file", "check"], "left").where(F.col("kept").isNull() | (place == F.col("kept")))
    return out.select("path", "file_name", "key", "piece", "pos", "raw")
