"""Exact text likelihoods under a hidden Markov language model.

A text is its words (A-Z lower-cased) and one end. Latent states emit word classes:
the end and the FREQUENT most frequent words are classes of their own, every other
word belongs to one of SUFFIXES classes by the hash of its last letters. Within a
class a word has its smoothed share of the class's training counts, so the model is a
proper distribution over texts: the scaled forward recursion gives the exact likelihood
of the classes, and the words' shares multiply it.

Training: word counts are summed over all training documents. Baum-Welch starts from
random states and goes PASSES times over all training documents, whole ones, each pass
in BLOCKS blocks by hash. A block's expected counts, added up by each task and summed
by Spark, are averaged into those of the blocks before, with the falling weight of
stepwise expectation maximisation, and the model is estimated anew, so it moves BLOCKS
times a pass. A last, plain round over all documents at once gives the model used.
The number of words grows with the corpus and never leaves the executors: the words with
the highest counts, at most HEAD and none with the count of one left out, go with the
model, the other words are joined by value.

Each row gives an output row, repeated rows included. A null or empty text is one end.
A null id is in no fold, so its text is learned from. With nothing to learn from, counts
are 0 and the model is uniform over its classes. A very long text is one sequence like
any other, its forward probabilities carried on from run to run. Words of equal counts
are ordered by themselves. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, in_fold

STATES = 8
FREQUENT, SUFFIXES, SUFFIX_BYTES = 8191, 4096, 4
#: Words whose counts go with the model.
HEAD = 1 << 17
#: Passes over the blocks of documents, the blocks, and the power of a step's number that its weight falls with.
PASSES, BLOCKS, FALL = 2, 8, 0.6
#: Tokens held as matrices at once, and texts cut into words together.
BATCH_TOKENS, BATCH_ROWS = 150_000, 1000
#: Tokens whose documents are sorted by length together in training, and documents that go side by side even if long.
POOL_TOKENS, WIDE = 2_000_000, 64
FOLDS, HELD_OUT = 7, 2
CLASSES = 1 + FREQUENT + SUFFIXES
#: Prior counts added to expected counts.
PRIOR = 0.01

CODED = "row long, doc_id long, held_out boolean, block int, n_tokens long, known long, log_counts double, log_shares double, classes binary, tail array<string>"


def split_words(texts: pa.Array) -> pa.ListArray:
    """Words of each text, A-Z lower-cased."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(trimmed, ""), None, trimmed))  # blanks at an end would be words


def suffix_class(word: str) -> int:
    return 1 + FREQUENT + zlib.crc32(word.encode()[-SUFFIX_BYTES:]) % SUFFIXES


@dataclass
class Vocabulary:
    """What goes with every task: bounded by HEAD words and CLASSES classes."""

    head: dict[str, tuple[int, int]]  # word: (count, class)
    docs: int  # training documents, the count of the end
    tokens: int
    types: int
    class_tokens: np.ndarray
    class_types: np.ndarray

    def share(self, count: int, k: int) -> float:
        """log10 of a word's share of its class; an unseen word's share is that of one more type."""
        return 0.0 if k <= FREQUENT else float(np.log10((count + 1) / (self.class_tokens[k] + self.class_types[k] + 1)))


def word_counts(training: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                found = split_words(whole.slice(at, BATCH_ROWS).column("text")).flatten().value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

    return training.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_words(counts: DataFrame) -> list[tuple[str, int]]:
    """At most HEAD words with the highest counts, all words of a count or none, in falling order."""
    n = F.col("n")
    level = F.when(n < 4096, n).otherwise(4096 + F.floor(256 * F.log2(n / 4096)))
    levels, least, held = counts.groupBy(level.alias("level")).count().collect(), None, 0  # some 20,000 rows at most
    for x in sorted(levels, key=lambda x: -x["level"]):
        held += x["count"]
        if held > HEAD:
            break
        least = x["level"]
    if least is None:
        return []
    head = counts.where(level >= least).toArrow()  # at most HEAD words
    return sorted(zip(head.column("word").to_pylist(), head.column("n").to_pylist(), strict=True), key=lambda x: (-x[1], x[0].encode()))


def vocabulary(counts: DataFrame, docs: int) -> Vocabulary:
    suffix = F.crc32(F.substring(F.col("word").cast("binary"), -SUFFIX_BYTES, SUFFIX_BYTES)) % SUFFIXES
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words, ns = zip(*found, strict=True) if (found := head_words(counts)) else ((), ())
    known = {w: (n, 1 + k if k < FREQUENT else suffix_class(w)) for k, (w, n) in enumerate(zip(words, ns, strict=True))}
    class_tokens, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for s, n, t in counts.groupBy(suffix.cast("int").alias("s")).agg(F.sum("n"), F.count("*")).collect():  # at most SUFFIXES rows
        class_tokens[1 + FREQUENT + s], class_types[1 + FREQUENT + s] = n, t
    for k, (w, n) in enumerate(zip(words[:FREQUENT], ns, strict=False)):  # these are classes of their own
        s = suffix_class(w)
        class_tokens[s] -= n
        class_types[s] -= 1
        class_tokens[1 + k], class_types[1 + k] = n, 1
    class_tokens[0], class_types[0] = docs, 1
    return Vocabulary(known, docs, total + docs, types + (docs > 0), class_tokens, class_types)


def coded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Class sequences of all documents, sums over their frequent words, and their other words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        by_word = {w: (k, np.log10(n + 1), v.share(n, k), 1) for w, (n, k) in v.head.items()}
        share = [v.share(0, k) for k in range(CLASSES)]
        end = np.log10(v.docs + 1)

        def values(word: str) -> tuple[int, float, float, int]:
            return by_word.get(word) or (k := suffix_class(word), 0.0, share[k], 0)

        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                split = split_words(b.column("text"))
                words = split.flatten().dictionary_encode()
                found = [values(w) for w in words.dictionary.to_numpy(zero_copy_only=False)]
                classes, counts, shares, known = (np.array(x, t) for x, t in zip(zip(*found, strict=True) if found else ((),) * 4, ("<u2", float, float, bool), strict=True))
                of, n = words.indices.to_numpy(), b.num_rows
                offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
                doc = np.repeat(np.arange(n), np.diff(offsets))
                coded = np.zeros(len(of) + n, "<u2")  # the end is class 0
                coded[np.arange(len(of)) + doc] = classes[of]
                ends = pa.py_buffer((2 * (offsets + np.arange(n + 1))).astype(np.int32))
                tail = ~known[of]
                rare = np.concatenate(([0], np.cumsum(np.bincount(doc[tail], minlength=n)))).astype(np.int32)

                def sums(x: np.ndarray) -> np.ndarray:
                    return np.bincount(doc, x[of], n)

                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("row"), b.column("doc_id"), b.column("held_out"), b.column("block"), pa.array(np.diff(offsets).astype(np.int64) + 1), pa.array(sums(known).astype(np.int64) + (v.docs > 0)),
                        pa.array(sums(counts) + end), pa.array(sums(shares)), pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(coded)]),
                        pa.ListArray.from_arrays(pa.array(rare), words.dictionary.take(pa.array(of[tail]))),
                    ],
                    ["row", "doc_id", "held_out", "block", "n_tokens", "known", "log_counts", "log_shares", "classes", "tail"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "text")
    return rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "row"), F.lit(BLOCKS)).cast("int")).mapInArrow(run, CODED)


@dataclass
class Model:
    start: np.ndarray  # STATES
    step: np.ndarray  # STATES x STATES
    emit: np.ndarray  # CLASSES x STATES


def ranked(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sequences by decreasing length as one array, position by position; where each position starts."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # sequences longer than t
    starts = np.concatenate(([0], np.cumsum(active)))
    flat = np.concatenate([sequences[i] for i in order])
    t = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.empty_like(flat)
    out[starts[t] + np.repeat(np.arange(len(order)), lengths)] = flat
    return out, starts, order


def forward(model: Model, classes: np.ndarray, starts: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Emissions, scaled forward probabilities and scales of every token; before: those probabilities of the position before."""
    emit = model.emit[classes]
    alpha, scale = np.empty_like(emit), np.empty(len(classes))
    for t in range(len(starts) - 1):
        a, b = starts[t], starts[t + 1]
        last = alpha[starts[t - 1] : starts[t - 1] + b - a] if t else before
        now = (model.start if last is None else last[: b - a] @ model.step) * emit[a:b]
        scale[a:b] = s = now.sum(1)
        np.divide(now, s[:, None], out=alpha[a:b])
    return emit, alpha, scale


def likelihoods(model: Model, sequences: list[np.ndarray]) -> list[float]:
    """log10 likelihood of each class sequence."""
    classes, starts, order = ranked(sequences)
    _, _, scale = forward(model, classes, starts)
    logs, total = np.log10(scale), np.zeros(len(order))
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        total[: b - a] += logs[a:b]
    out = np.empty(len(order))
    out[order] = total
    return out.tolist()


def counted(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of starts, steps and emissions, and the log10 likelihood.

    Positions are taken in runs of about BATCH_TOKENS tokens: a first walk keeps the forward probabilities at
    the runs' borders, the way back computes those of one run at a time. The sums are those of whole sequences.
    """
    classes, starts, _ = ranked(sequences)
    positions, cuts = len(starts) - 1, [0]
    while cuts[-1] < positions:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(starts, starts[cuts[-1]] + BATCH_TOKENS, side="right")) - 1))
    runs = [(classes[starts[x] : starts[y]], starts[x : y + 1] - starts[x]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    borders: list[np.ndarray | None] = [None]
    for part, at in runs[:-1]:
        borders.append(forward(model, part, at, borders[-1])[1][at[-2] :].copy())
    step, emission, logs = np.zeros_like(model.step), np.zeros((CLASSES, len(model.start))), 0.0
    right = np.zeros((0, len(model.start)))  # of the position after
    for (part, at), before in zip(reversed(runs), reversed(borders), strict=True):
        emit, alpha, scale = forward(model, part, at, before)
        beta = np.ones_like(alpha)
        ahead = emit / scale[:, None]
        for t in range(len(at) - 2, -1, -1):
            a, n = at[t], len(right)
            beta[a : a + n] = right @ model.step.T
            step += alpha[a : a + n].T @ right
            right = ahead[a : at[t + 1]] * beta[a : at[t + 1]]
        gamma = alpha * beta
        emission += np.stack([np.bincount(part, gamma[:, k], CLASSES) for k in range(gamma.shape[1])], 1)
        logs += float(np.log10(scale).sum())
    return gamma[: starts[1]].sum(0), step * model.step, emission, logs


def expected(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of starts, steps and emissions."""
    return counted(model, sequences)[:3]


def batches_of(sequences: list[np.ndarray], wide: int = 1) -> Iterator[list[np.ndarray]]:
    """Runs of sequences of like length that together hold about BATCH_TOKENS tokens, or are wide in number."""
    held, size = [], 0
    for s in sequences:
        if len(held) >= wide and size + len(s) > BATCH_TOKENS:
            yield held
            held, size = [], 0
        held.append(s)
        size += len(s)
    if held:
        yield held


def pools(columns: Iterator[pa.Array]) -> Iterator[list[np.ndarray]]:
    """All sequences of the columns in pools of about POOL_TOKENS tokens, by decreasing length."""
    held, size = [], 0
    for column in columns:
        for s in sequences_of(column):
            held.append(s)
            size += len(s)
            if size >= POOL_TOKENS:
                yield sorted(held, key=len, reverse=True)
                held, size = [], 0
    yield sorted(held, key=len, reverse=True)


def normalised(start: np.ndarray, step: np.ndarray, emission: np.ndarray, shape: np.ndarray) -> Model:
    """Model of expected counts; the prior follows the classes' overall frequencies."""
    prior = (shape + 1) / (shape + 1).sum()
    emit = emission + PRIOR * emission.sum(0) * prior[:, None] + prior[:, None]
    return Model((start + 1) / (start + 1).sum(), (step + 1) / (step + 1).sum(1, keepdims=True), emit / emit.sum(0))


def initial(shape: np.ndarray) -> Model:
    """States that are likely to stay and emit at random."""
    random = np.random.RandomState(7)
    counts = (shape + 1)[:, None] * random.gamma(1.0, 1.0, (CLASSES, STATES))
    return normalised(np.ones(STATES), np.eye(STATES) * 900 + 10, counts, shape)


def sequences_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2").astype(np.int64) for x in column.to_pylist()]


@dataclass
class Counts:
    """Expected counts of starts, steps and emissions, the log10 likelihood and the tokens they come from."""

    start: np.ndarray
    step: np.ndarray
    emission: np.ndarray
    log: float
    tokens: float

    def mixed(self, other: Counts, weight: float) -> Counts:
        """The counts a token of both, the other's with a weight."""
        a, b = (1 - weight) / self.tokens, weight / other.tokens
        return Counts(*(a * x + b * y for x, y in ((self.start, other.start), (self.step, other.step), (self.emission, other.emission))), 0.0, 1.0)

    def model(self, shape: np.ndarray, tokens: float) -> Model:
        """The model these counts give if they come from so many tokens."""
        by = tokens / self.tokens
        return normalised(self.start * by, self.step * by, self.emission * by, shape)


def baum_welch(training: DataFrame, model: Model) -> Counts | None:
    """Expected counts of the given documents; none without any."""
    spark = training.sparkSession
    shared = spark.sparkContext.broadcast(model)
    columns = [f"s{k}" for k in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        start, step, emission, logs = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES)), np.zeros(STATES)
        for pool in pools(b.column("classes") for b in batches):
            for part in batches_of(pool, WIDE):
                x, y, z, log = counted(m, part)
                start += x
                step += y
                emission += z
                logs[0] += log
        rows = np.concatenate([emission, step, start[None], logs[None]])
        used = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(rows[used, k]) for k in range(STATES))], ["at", *columns])

    sums = training.select("classes").mapInArrow(run, "at int, " + ", ".join(f"{c} double" for c in columns)).groupBy("at").agg(*(F.sum(c).alias(c) for c in columns))
    total = np.zeros((CLASSES + STATES + 2, STATES))
    found = sums.toArrow()  # at most CLASSES + STATES + 2 rows
    total[found.column("at").to_numpy()] = np.stack([found.column(c).to_numpy() for c in columns], 1)
    shared.unpersist()
    tokens = total[:CLASSES].sum()
    return Counts(total[-2], total[CLASSES:-2], total[:CLASSES], total[-1, 0], tokens) if tokens else None


def train(rows: DataFrame, shape: np.ndarray, tokens: int) -> Model:
    """The model of all rows not held out; tokens: how many they hold."""
    training = rows.where(~F.col("held_out"))
    model, sums, steps = initial(shape), None, 0
    for _ in range(PASSES):
        for block in range(BLOCKS):
            now = baum_welch(training.where(F.col("block") == block), model)
            if now:
                sums = sums.mixed(now, (steps + 1) ** -FALL) if sums else now
                model, steps = sums.model(shape, tokens), steps + 1
    last = baum_welch(training, model)
    return last.model(shape, tokens) if last else model


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark: SparkSession = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    training = docs.where(~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    counts = cut(word_counts(training), "word-counts")
    v = vocabulary(counts, training.count())
    rows = cut(coded(docs, v), "coded", "block")  # a block's files are read alone
    shape = v.class_tokens + v.class_types
    shared = spark.sparkContext.broadcast(train(rows, shape, v.tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = sequences_of(b.column("classes"))
            order = sorted(range(len(found)), key=lambda i: -len(found[i]))  # like lengths together
            logs, at = np.empty(len(found)), 0
            for part in batches_of([found[i] for i in order]):
                logs[order[at : at + len(part)]] = likelihoods(m, part)
                at += len(part)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "doc_id", "held_out", "n_tokens", "known", "log_counts", "log_shares")), pa.array(logs)], ["row", "doc_id", "held_out", "n_tokens", "known", "log_counts", "log_shares", "log_classes"])

    kept = "row long, doc_id long, held_out boolean, n_tokens long, known long, log_counts double, log_shares double, log_classes double"
    scored = rows.select("row", "doc_id", "held_out", "n_tokens", "known", "log_counts", "log_shares", "classes").mapInArrow(run, kept)
    # The words beyond the head, counted in each document, meet their counts by value.
    tail = rows.select("row", F.explode("tail").alias("word"))
    tail = tail.join(counts, "word").groupBy("row").agg(F.count("*").alias("tail_known"), F.sum(F.log10(F.col("n") + 1)).alias("tail_logs"))
    out = scored.join(tail, "row", "left")
    logs = F.coalesce("tail_logs", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + logs - F.col("n_tokens") * float(np.log10(v.tokens + v.types + 1))).alias("base_score"),
        (F.col("log_classes") + F.col("log_shares") + logs).alias("score"),
    )
