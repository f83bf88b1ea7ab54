"""Toxicity scores from a subsequence string-kernel support vector machine.

Words are compared by a gap-weighted subsequence kernel: all character triples in
order, at most SPAN characters apart, weighted by DECAY to the power of their span
and normalised, so words with gaps or inserted characters stay near. A sentence is
described by its best match with each of LANDMARKS words (Nystroem landmarks). Words
spelt with dots, spaces or other gaps are also read without them: a word with marks
inside closes up, and runs of pieces of up to FRAGMENT letters are matched in all their
windows, across the ends of sentences too. A word split into longer pieces by white
space is matched piece by piece. The
landmarks' kernel matrix whitens these features and a linear support vector machine
is trained on labelled sentences. A document's score is the calibrated margin of its
worst sentence.

Training takes at most TRAIN_DOCS documents of each label, those with the smallest
hash, from the training fold (of rows that share an id the greatest text), and of each
the TRAIN_SENTENCES sentences with the strongest matches. Their texts stay on the
executors, which count words and describe sentences; the driver gets the pool of
typical words, a bit for each of them and document, and the described sentences.
Labels hold for documents, so a toxic document's sentences start with those that hold
words typical of toxic documents and are reassigned to its worst sentences as training
goes on.

Each input row gives one output row, repeated rows included. A null or empty text
has no words and gets the score of a text without any match. A very long text is read
whole, a row at a time. Words that are equally typical are ordered by themselves.
Without both labels in the training fold every score is 0. An empty table gives no
rows. Extra columns are ignored; labels, language, source and id are never inputs of a
score.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_fold

#: Training documents of each label, and sentences of each; they bound what one task fits.
TRAIN_DOCS, TRAIN_SENTENCES = 3000, 32
#: Partitions of the training documents.
TRAIN_PARTS = 24
#: Words counted before they are passed on.
COUNTED = 200_000
LANDMARKS = 64
SPAN, DECAY = 6, 0.7
#: Longer words are cut into overlapping parts of this many characters.
WORD = 24
ROUNDS, SVM_STEPS, C = 3, 300, 10.0
#: Words that may become landmarks.
POOL = 2000
THRESHOLD = 0.3
#: Least log ratio of a typical word's frequencies in toxic and clean documents.
TYPICAL = 2.0
FOLDS, HELD_OUT = 4, 2
#: Words a worker keeps; bounds its memory. Words met later are described for their batch alone.
KEPT_WORDS = 500_000
#: Kernel values below this count as no match.
FLOOR = 0.25
#: Power of the kernel, itself a kernel: near words count far more than those that share a syllable.
POWER = 5
#: Least eigenvalue of the landmarks' kernel matrix that whitening keeps.
LEAST = 1e-2
#: Sentences end at punctuation before white space or the end, and at line ends; marks inside words don't end them.
SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
PIECE = re.compile(r"[^\W_]+")
#: Runs of pieces of so many letters, whatever lies between them, are also read as windows without the gaps.
FRAGMENT = 3
TABLE = 1 << 15
SCHEMA = "doc_id long, held_out boolean, score double, margin double"


def parts_of(word: str) -> list[str]:
    if len(word) <= WORD:
        return [word]
    return [word[k : k + WORD] for k in range(0, len(word) - WORD // 2, WORD // 2)]


def words_of(sentence: str, run: list[str]) -> list[str]:
    """Words of a sentence, readings of words with marks inside, and windows of short fragments.

    run holds the fragments before the sentence, whose windows may reach into it, and is carried on.
    """
    out = []
    for w in sentence.split():
        if not w.isalnum():
            w = w.strip(",;:|\"'()[]{}.!?")
            if not w.isalnum():
                pieces = PIECE.findall(w)
                out += marked_readings(w, pieces)
                for p in pieces:
                    add_windows(p, run, out)
                continue
        size = len(w)
        if size <= FRAGMENT:
            out.append(w)
            add_windows(w, run, out)
            continue
        if size <= WORD:  # most words
            out.append(w)
        else:
            out += parts_of(w)
        if run:
            run.clear()
    return out


def marked_readings(word: str, pieces: list[str]) -> list[str]:
    """A word with marks inside as it stands, closed up, with i for exclamation marks, and by its pieces where marks may also have ended a sentence."""
    out = parts_of(word)
    if len(pieces) > 1:
        out += parts_of("".join(pieces))
        if "!" in word:
            out += parts_of("".join(PIECE.findall(word.replace("!", "i"))))
        if any(c in word for c in ".!?"):
            for p in pieces:
                out += parts_of(p)
    return out


def add_windows(piece: str, run: list[str], out: list[str]) -> None:
    """Adds a piece to the run of fragments, and to out the windows that end with it; a long piece or a number ends the run."""
    if len(piece) > FRAGMENT or piece.isdigit():
        run.clear()
        return
    run.append(piece)
    if len(run) < 2:
        return
    del run[:-WORD]
    window = piece
    for before in run[-2::-1]:
        window = before + window
        if len(window) > WORD:
            break
        if len(window) >= 3:
            out.append(window)


def sentences_of(text: str) -> list[list[str]]:
    run: list[str] = []
    return [w for s in SENTENCE.split(text.lower()) if (w := words_of(s, run))]


def characters(words: list[str]) -> np.ndarray:
    """All characters of words, one after another, mixed."""
    return (np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4") * np.uint32(2654435761)) >> np.uint32(16)


def spans(chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(k, j, codes): the code of the characters at 0, j and k from each place on, for all pairs 0 < j < k < SPAN."""
    n, ahead = len(chars), chars * np.uint32(31)
    for k in range(2, min(SPAN, n)):
        for j in range(1, k):
            code = (ahead[: n - k] + chars[j : n - k + j]) * np.uint32(1009) + chars[k:]
            yield k, j, (code * np.uint32(2246822519)) >> np.uint32(17)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of every subsequence of three characters, at most SPAN apart."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    chars = characters(words)
    word, left = np.repeat(np.arange(len(words)), lengths), np.repeat(np.cumsum(lengths), lengths) - np.arange(len(chars))
    rows, codes, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for k, _, code in spans(chars):
        at = np.flatnonzero(left[:-k] > k)
        rows.append(word[at])
        codes.append(code[at].astype(np.int64))
        weights.append(np.full(len(at), DECAY ** (k + 1)))
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(weights)


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of the distinct subsequences, by word, normalised per word."""
    row, code, weight = subsequences(words)
    if not len(row):
        return row, code, weight
    key = row * TABLE + code
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    weight = np.add.reduceat(weight, first)
    word, code = key[first] // TABLE, key[first] % TABLE
    return word, code, weight / np.sqrt(np.bincount(word, weight**2, len(words)))[word]


@dataclass
class Model:
    landmarks: list[str]
    table: np.ndarray  # TABLE x landmarks: normalised weights of each code
    weights: np.ndarray  # on the best matches
    bias: float
    slope: float
    offset: float
    empty: bool = False

    @cached_property
    def weighted(self) -> tuple[np.ndarray, ...]:
        """(used, first, landmark, value): which codes any landmark holds, and for each code from which place on its landmarks and values stand."""
        code, landmark = np.nonzero(self.table)
        return self.table.any(1), np.searchsorted(code, np.arange(TABLE + 1)), landmark, self.table[code, landmark].astype(float)

    def reaching(self, words: list[str]) -> np.ndarray:
        """Places of the words that may reach FLOOR: only of these the codes are sorted and summed.

        Weights of equal codes add up, so they give the same product with a landmark unsummed, and a norm that is no greater.
        That norm follows from the length.
        """
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        chars = characters(words)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(chars))  # characters to the word's end
        used, first, landmark, value = self.weighted
        places, codes, weights = [], [], []
        for k, j, code in spans(chars):
            at = np.flatnonzero(used[code] & (left[:-k] > k))
            places.append(at)
            codes.append(code[at])
            weights.append(np.full(len(at), DECAY ** (k + 1)))
        if not places:
            return np.zeros(0, np.int64)
        place, code, weight = np.concatenate(places), np.concatenate(codes), np.concatenate(weights)
        size = first[code + 1] - first[code]
        entry = np.repeat(first[code] - np.cumsum(size) + size, size) + np.arange(size.sum())
        word = np.repeat(np.repeat(np.arange(n), lengths)[place], size)
        products = np.bincount(word * len(self.landmarks) + landmark[entry], np.repeat(weight, size) * value[entry], n * len(self.landmarks)).reshape(n, -1)
        norm = sum((k - 1) * np.maximum(lengths - k, 0) * DECAY ** (2 * k + 2) for k in range(2, SPAN))
        return np.flatnonzero((products.max(1) > 0) & (products.max(1) >= 0.999 * FLOOR * np.sqrt(norm)))

    def matches(self, words: list[str]) -> np.ndarray:
        """Kernel values of words with the landmarks."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        near = self.reaching(words)
        if not near.size:
            return out
        word, code, weight = triples([words[k] for k in near])
        word = near[word]
        shared = np.flatnonzero(self.weighted[0][code])  # other subsequences add nothing
        word, code, weight = word[shared], code[shared], weight[shared]
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        out[word[first]] = np.add.reduceat(self.table[code] * weight[:, None].astype(np.float32), first, axis=0)
        out[out < FLOOR] = 0
        return out**POWER


class Matcher:
    """Best matches of sentences, with a bounded table of words seen; row 0 is no match."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.store = np.zeros((1, len(model.landmarks)), np.float32)

    def sentences(self, sentences: list[list[str]]) -> np.ndarray:
        flat = [w for s in sentences for w in s]
        rows, store = self.rows, self.store
        new = list(set(flat).difference(rows))
        if new:
            found = np.concatenate([self.model.matches(new[k : k + 2048]) for k in range(0, len(new), 2048)])
            some = np.flatnonzero(found.any(1))
            at = np.zeros(len(new), np.int64)
            at[some] = np.arange(len(store), len(store) + len(some))
            fresh, store = dict(zip(new, at.tolist(), strict=True)), np.concatenate([store, found[some]])
            if len(rows) + len(fresh) <= KEPT_WORDS:
                rows.update(fresh)
                self.store = store
            else:
                rows = {w: rows[w] if w in rows else fresh[w] for w in set(flat)}
        at = np.fromiter(map(rows.__getitem__, flat), np.int64, len(flat))
        starts = np.cumsum([0, *map(len, sentences[:-1])])
        out = np.zeros((len(sentences), store.shape[1]), np.float32)
        some = np.flatnonzero(at)  # the other words match nothing
        if some.size:
            owner = np.searchsorted(starts, some, "right") - 1
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            out[owner[first]] = np.maximum.reduceat(store[at[some]], first, axis=0)
        return out

    def documents(self, texts: list[str | None]) -> np.ndarray:
        """Margin of each text's worst sentence; that of no match for a text without words."""
        out = np.full(len(texts), self.model.bias)
        split, owner = [], []
        for k, text in enumerate(texts):
            found = sentences_of(text or "")
            split += found
            owner += [k] * len(found)
        if split:
            margins = self.sentences(split) @ self.model.weights + self.model.bias
            top = np.full(len(texts), -np.inf)
            np.maximum.at(top, owner, margins)
            out = np.where(np.isfinite(top), top, out)
        return out


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss and costs per row, by Newton steps on the active rows."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    before = np.inf
    for _ in range(SVM_STEPS):
        slack = np.maximum(0, 1 - y * (x1 @ w))
        active = slack > 0
        xa = x1[active] * cost[active, None]
        loss = w @ ridge @ w / 2 + (cost * slack**2).sum() / 2
        if before - loss < 1e-9 * before:
            break
        before = loss
        w = np.linalg.solve(ridge + xa.T @ x1[active], xa.T @ y[active])
    return w[:-1], float(w[-1])


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(1) = 1 / (1 + exp(-(slope * margin + offset))), with a weak prior."""
    x, w = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), x.T @ (y - p) - 0.1 * (w - [1, 0]))
        w = w + np.clip(step, -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


def word_documents(train: DataFrame) -> DataFrame:
    """word, toxic, clean: in how many toxic and clean training documents a word is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            words = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in reversed(counts))], ["word", "toxic", "clean"])

        for b in batches:
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                counts[toxic].update({w for s in sentences_of(text.as_py() or "") for w in s})
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield out()
                    counts[0].clear()
                    counts[1].clear()
        yield out()

    return train.mapInArrow(run, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def typical(counts: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """At most POOL words of toxic documents, by how much more often they are found there than in clean ones."""
    ratio = F.log((F.col("toxic") + 0.5) / (n_toxic + 1) * (n_clean + 1) / (F.col("clean") + 0.5))
    found = counts.where((F.col("toxic") >= 2) & (F.char_length("word") >= 3)).withColumn("gain", F.col("toxic") * ratio)
    found = found.where((ratio > TYPICAL) & (F.col("gain") > 8)).orderBy(F.col("gain").desc(), "word").limit(POOL)
    return [r["word"] for r in found.select("word").collect()]


def in_one_task(rows: DataFrame, use: Callable[[pa.Table], object]) -> object:
    """use(table) of rows whose number a parameter bounds, worked out by an executor, so that the driver holds what comes of it alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(use(pa.Table.from_batches(batches)))], pa.binary())], ["made"])

    return pickle.loads(rows.repartition(1).mapInArrow(run, "made binary").first()["made"])


def chosen_landmarks(train: DataFrame, pool: list[str]) -> list[str]:
    """choose_landmarks() over the toxic training documents, by id: TRAIN_DOCS rows of POOL bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {w: k for k, w in enumerate(pool)}
        for b in batches:
            held = np.zeros((b.num_rows, len(pool)), bool)
            for row, text in zip(held, b.column("text"), strict=True):
                row[[at[w] for w in at.keys() & {w for s in sentences_of(text.as_py() or "") for w in s}]] = True
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array([x.tobytes() for x in np.packbits(held, 1)], pa.binary())], ["_id", "held"])

    def choose(rows: pa.Table) -> list[str]:
        bits = np.frombuffer(b"".join(rows.sort_by("_id").column("held").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
        return choose_landmarks(pool, np.unpackbits(bits, 1, len(pool)).astype(bool))

    return in_one_task(train.where("toxic = 1").mapInArrow(run, "_id long, held binary"), choose)


def described(train: DataFrame, landmarks: list[str], known: set[str]) -> DataFrame:
    """_id, toxic, at, blank, marked, matches of the training documents' sentences that match the landmarks best.

    A document's first row also holds the number of its sentences without any match; matches are null where it has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, rows = Matcher(landmark_model(landmarks)), []
        for b in batches:
            for doc, text, toxic in zip(b.column("_id").to_pylist(), b.column("text"), b.column("toxic").to_pylist(), strict=True):
                split = sentences_of(text.as_py() or "")
                found = matcher.sentences(split) if split else np.zeros((0, 1), np.float32)
                some = np.flatnonzero(found.any(1))
                blank = len(split) - len(some)
                some = np.sort(some[np.argsort(-found[some].max(1), kind="stable")[:TRAIN_SENTENCES]]) if len(some) else some
                for k, i in enumerate(some):
                    rows.append((doc, toxic, k, 0 if k else blank, not known.isdisjoint(split[i]), found[i].tobytes()))
                if not len(some):
                    rows.append((doc, toxic, 0, blank, False, None))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["_id", "toxic", "at", "blank", "marked", "matches"])

    return train.mapInArrow(run, "_id long, toxic int, at int, blank long, marked boolean, matches binary")


def choose_landmarks(pool: list[str], held: np.ndarray) -> list[str]:
    """Each next landmark is the word found in most toxic documents that are still covered least; held: documents x pool."""
    weight, chosen = np.ones(len(held)), []
    left = list(range(len(pool)))
    while left and len(chosen) < LANDMARKS:
        best = left.pop(int(np.argmax(weight @ held[:, left])))
        weight[held[:, best]] /= 2
        chosen.append(pool[best])
    return chosen


def empty_model() -> Model:
    return Model(["---"], np.zeros((TABLE, 1), np.float32), np.zeros(1), 0.0, 1.0, 0.0, True)


def landmark_model(landmarks: list[str]) -> Model:
    """Kernel of the landmarks, no weights yet."""
    word, code, weight = triples(landmarks)
    table = np.zeros((TABLE, len(landmarks)), np.float32)
    table[code, word] = weight
    return Model(landmarks, table, np.zeros(len(landmarks)), 0.0, 1.0, 0.0)


def whitening(model: Model) -> np.ndarray:
    """Matrix that turns matches with the landmarks into Nystroem features: their products are the kernel's on the landmarks."""
    values, vectors = np.linalg.eigh(model.matches(model.landmarks).astype(float))
    keep = values > LEAST
    return vectors[:, keep] / np.sqrt(values[keep])


def fitted(landmarks: list[str], rows: pa.Table) -> tuple[np.ndarray, float, float, float]:
    """Weights, bias, slope and offset of the described training sentences, 2 * TRAIN_DOCS * TRAIN_SENTENCES rows at most."""
    model, rows = landmark_model(landmarks), rows.sort_by([("_id", "ascending"), ("at", "ascending")])
    ids, doc = np.unique(rows.column("_id").to_numpy(), return_inverse=True)
    y = np.zeros(len(ids), int)
    y[doc] = rows.column("toxic").to_numpy()
    filled = rows.column("matches").is_valid().to_numpy()
    owner, marked = doc[filled], rows.column("marked").to_numpy()[filled]
    matches = np.frombuffer(b"".join(rows.column("matches").drop_null().to_pylist()), np.float32).reshape(-1, len(landmarks))
    # Sentences without any match are all alike: those of clean documents count as one row with their number as its weight.
    blank = int(rows.column("blank").to_numpy()[rows.column("toxic").to_numpy() == 0].sum())
    whiten = whitening(model)
    feats = np.concatenate([matches, np.zeros((1, len(landmarks)), np.float32)]) @ whiten
    negative = np.append(y[owner] == 0, True)
    number = np.append(np.ones(len(owner)), max(1, blank))
    marked = np.append(marked, False)
    for _ in range(ROUNDS):
        positive = ~negative & marked
        use = np.flatnonzero(positive | negative)
        total = number[use].sum()
        cost = number[use] * np.where(positive[use], C / max(1, positive.sum()), C / number[negative].sum()) * total / 2
        w, bias = svm(feats[use], np.where(positive[use], 1.0, -1.0), cost)
        margins = feats[:-1] @ w + bias
        marked = np.append(margins > 0, False)
        top = np.full(len(y), -np.inf)
        np.maximum.at(top, owner, margins)
        marked[:-1] |= (margins == top[owner]) & (margins > -0.5)  # each toxic document keeps its worst sentence unless it looks clean
    return whiten @ w, bias, *logistic(np.maximum(top, bias), y)


def fit(train: DataFrame) -> Model:
    """Model from whole labelled documents (_id, text, toxic), one row for each id."""
    sizes = dict(train.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    signal = typical(word_documents(train), n_toxic, n_clean) if n_toxic and n_clean else []
    if not signal:
        return empty_model()
    landmarks = chosen_landmarks(train, signal)
    model = landmark_model(landmarks)
    made = in_one_task(described(train, landmarks, set(signal[:500])), lambda rows: fitted(landmarks, rows))
    model.weights, model.bias, model.slope, model.offset = made
    return model


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> DataFrame:
    """_id, text, toxic of at most per_label documents of each label from the training fold, those with the smallest hash."""
    labelled = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    labelled = labelled.where(F.col("_id").isNotNull() & ~in_fold(F.col("_id"), FOLDS, HELD_OUT)).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    drawn = None
    for value in (0, 1):
        part = labelled.where(F.col("toxic") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_label)
        drawn = part if drawn is None else drawn.unionByName(part)
    # At most 2 * per_label ids are broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "_id")
    return cut(rows.groupBy("_id", "toxic").agg(F.max("text").alias("text")).repartition(TRAIN_PARTS, "_id"), "training-texts")


def probabilities(model: Model, margin: np.ndarray) -> np.ndarray:
    return np.zeros(len(margin)) if model.empty else 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, margin."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TABLE x LANDMARKS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        matcher = Matcher(m)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                margin = matcher.documents(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(probabilities(m, margin)), pa.array(margin)], ["doc_id", "held_out", "score", "margin"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "text").mapInArrow(run, SCHEMA)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, margin of every document."""
    model = fit(training_rows(docs, labels))
    return score(docs, model).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "margin")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose text is predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        matcher = Matcher(m)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                yield b.filter(pa.array(probabilities(m, matcher.documents(b.column("text").to_pylist())) < threshold))

    return docs.mapInArrow(run, docs.schema)
