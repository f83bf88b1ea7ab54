"""The trained operators: exact sums, exact likelihoods, held-out accuracy."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import hmm, toxicity

from .conftest import WORDS, prose


def test_likelihood_is_the_sum_over_state_paths():
    rng = np.random.RandomState(0)
    k, classes = 3, 5
    model = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(classes), k).T)
    sequences = [rng.randint(0, classes, n) for n in (4, 1, 6, 4)]
    for s, got in zip(sequences, hmm.likelihoods(model, sequences), strict=True):
        total = 0.0
        for path in itertools.product(range(k), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.step[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            total += p
        assert got == pytest.approx(np.log10(total))


def test_expected_counts_are_sums_over_state_paths(monkeypatch):
    rng = np.random.RandomState(1)
    k, classes = 2, 4
    monkeypatch.setattr(hmm, "CLASSES", classes)
    model = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(classes), k).T)
    sequences = [rng.randint(0, classes, n) for n in (5, 3, 1)]
    start, step, emission = np.zeros(k), np.zeros((k, k)), np.zeros((classes, k))
    for s in sequences:
        paths = {}
        for path in itertools.product(range(k), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.step[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            paths[path] = p
        total = sum(paths.values())
        for path, p in paths.items():
            start[path[0]] += p / total
            for t, state in enumerate(path):
                emission[s[t], state] += p / total
                if t:
                    step[path[t - 1], state] += p / total
    for got, want in zip(hmm.expected(model, sequences), (start, step, emission), strict=True):
        assert np.allclose(got, want)


@pytest.mark.parametrize("tokens", [1, 7, 50])
def test_expected_counts_do_not_depend_on_runs(monkeypatch, tokens):
    rng = np.random.RandomState(3)
    monkeypatch.setattr(hmm, "CLASSES", 6)
    model = hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(6), 3).T)
    sequences = [rng.randint(0, 6, n) for n in (40, 1, 17, 40, 3)]
    whole = hmm.counted(model, sequences)
    assert whole[3] == pytest.approx(sum(hmm.likelihoods(model, sequences)))
    monkeypatch.setattr(hmm, "BATCH_TOKENS", tokens)
    for got, want in zip(hmm.counted(model, sequences), whole, strict=True):
        assert np.allclose(got, want)


def test_every_round_sees_all_of_every_document(spark, monkeypatch):
    texts = ["alpha " * 3000 + "beta " * 3000, *["gamma delta"] * 5]
    seen, real = [], hmm.normalised

    def spy(start, step, emission, shape):
        seen.append((start.sum(), step.sum(), emission.sum()))
        return real(start, step, emission, shape)

    monkeypatch.setattr(hmm, "normalised", spy)
    hmm.score(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"))
    tokens = 6001 + 5 * 3
    assert len(seen) > 2
    for start, step, emission in [seen[-1]]:  # the last round, over all documents
        assert (start, step, emission) == (pytest.approx(6), pytest.approx(tokens - 6), pytest.approx(tokens))


def plain_model(sequences, shape, blocks):
    """Stepwise Baum-Welch over lists, by sums over all state paths' recursions in plain Python."""
    model = hmm.initial(shape)
    tokens = sum(map(len, sequences))

    def counts(some):
        k = hmm.STATES
        start, step, emission = np.zeros(k), np.zeros((k, k)), np.zeros((hmm.CLASSES, k))
        for s in some:
            alpha = [model.start * model.emit[s[0]]]
            for x in s[1:]:
                alpha.append((alpha[-1] @ model.step) * model.emit[x])
            beta = [np.ones(k)]
            for x in reversed(s[1:]):
                beta.append(model.step @ (model.emit[x] * beta[-1]))
            beta.reverse()
            whole = alpha[-1].sum()
            start += alpha[0] * beta[0] / whole
            for t, x in enumerate(s):
                emission[x] += alpha[t] * beta[t] / whole
                if t:
                    step += np.outer(alpha[t - 1], model.emit[x] * beta[t]) * model.step / whole
        return np.concatenate([emission, step, start[None]])

    def made(x):
        return hmm.normalised(x[-1], x[hmm.CLASSES : -1], x[: hmm.CLASSES], shape)

    sums, steps = None, 0
    for _ in range(hmm.PASSES):
        for block in range(hmm.BLOCKS):
            some = [s for s, b in zip(sequences, blocks, strict=True) if b == block]
            if some:
                now = counts(some) * tokens / sum(map(len, some))
                weight = (steps + 1) ** -hmm.FALL
                sums = now if sums is None else (1 - weight) * sums + weight * now
                model, steps = made(sums), steps + 1
    return made(counts(sequences))


def test_score_against_plain_python(spark):
    """Whole scores of held-out and other texts: classes, training, likelihood and shares, redone without matrices."""
    rng = random.Random(12)
    texts = [(d, " ".join(rng.choice(WORDS[:14]) for _ in range(rng.randint(0, 9)))) for d in range(60)] + [(99, "Never met words")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in texts}
    counts = Counter(w for d, t in texts if not held[d] for w in t.lower().split())
    order = sorted(counts, key=lambda w: (-counts[w], w))
    class_of = {w: 1 + k for k, w in enumerate(order)}

    def k_of(w):
        return class_of.get(w, hmm.suffix_class(w))

    n_docs = sum(not x for x in held.values())
    tokens, types = np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES)
    tokens[0], types[0] = n_docs, 1
    for w in order:
        tokens[class_of[w]] += counts[w]
        types[class_of[w]] += 1
    sequences = [[*map(k_of, t.lower().split()), 0] for _, t in texts]
    v = hmm.vocabulary(hmm.word_counts(docs.where(F.col("doc_id").isin([d for d, x in held.items() if not x]))), n_docs)
    blocks = [r["block"] for r in hmm.coded(docs, v).collect()]
    training = [(s, b) for (d, _), s, b in zip(texts, sequences, blocks, strict=True) if not held[d]]
    model = plain_model([s for s, _ in training], tokens + types, [b for _, b in training])
    want = {}
    for (d, t), s in zip(texts, sequences, strict=True):
        alpha = model.start * model.emit[s[0]]
        for x in s[1:]:
            alpha = (alpha @ model.step) * model.emit[x]
        shares = sum(np.log10((counts[w] + 1) / (tokens[k_of(w)] + types[k_of(w)] + 1)) for w in t.lower().split() if k_of(w) > hmm.FREQUENT)
        want[d] = np.log10(alpha.sum()) + shares
    for r in hmm.score(docs).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-6)


def test_language_model(docs, triples, nothing, monkeypatch):
    monkeypatch.setattr(hmm, "HEAD", 12)  # the other words take the join
    got = hmm.score(docs).collect()
    assert len(got) == len(triples)

    def tokens(t):
        return (t or "").encode().lower().split()

    def out(d):
        return d is not None and zlib.crc32(str(d).encode()) % 7 == 2

    counts = Counter(w for d, t, _ in triples if not out(d) for w in tokens(t))
    counts["end"] = sum(not out(d) for d, _, _ in triples)
    n, v = sum(counts.values()), len(counts)
    want = {}
    for d, t, _ in triples:
        c = [counts[w] for w in [*tokens(t), "end"]]
        want[d] = (out(d), len(c), sum(x > 0 for x in c), sum(np.log10((x + 1) / (n + v + 1)) for x in c))
    for r in got:
        held, length, known, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, length, known, n)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] < 0
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert hmm.score(nothing).count() == 0


def test_model_is_a_distribution_over_texts(spark, docs):
    """The shares of a class's words and of one unseen type sum to 1."""
    counts = hmm.word_counts(docs)
    v = hmm.vocabulary(counts, docs.count())
    mass = Counter()
    for w, n in counts.collect():
        k = v.head[w][1]
        mass[k] += 10 ** v.share(n, k)
    for k, m in mass.items():
        assert m + (10 ** v.share(0, k) if k > hmm.FREQUENT else 0) == pytest.approx(1)


INSULTS = ["grumblenitwit", "sloppyfool", "dullardish"]


def labelled(rng, n):
    rows = []
    for d in range(n):
        text = ". ".join(prose(rng, 9) for _ in range(rng.randint(1, 6)))
        toxic = int(rng.random() < 0.3)
        if toxic:
            word = rng.choice(INSULTS)
            if rng.random() < 0.3:
                at = rng.randint(2, len(word) - 2)
                word = word[:at] + rng.choice("-*._") + word[at:]
            text = text.replace(rng.choice(WORDS[:12]), word, 1) + f" {word}."
        rows.append((d, text, toxic))
    return rows


def test_toxicity(spark, nothing):
    rows = labelled(random.Random(9), 400)
    texts = [(d, t) for d, t, _ in rows] + [(1000, None), (1001, ""), (1002, "x" * 5000 + " " + INSULTS[0]), (1003, "gr-umble.nitwit is what"), (None, "a text")]
    docs = spark.createDataFrame([(*r, 0.5) for r in texts], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(d, v) for d, _, v in rows] + [(5, None), (None, 1), (7, rows[7][2])], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(texts)
    test = [(got[d]["predicted"], v) for d, _, v in rows if got[d]["held_out"]]
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, _, _ in rows)
    assert np.mean([p == v for p, v in test]) > 0.95
    assert got[1002]["predicted"] == 1 and got[1000]["predicted"] == got[1001]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {d for d, r in got.items() if not r["predicted"]}
    assert toxicity.toxicity(nothing, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.toxicity(docs, none).collect()} == {0}


def plain_kernel(u, v):
    """Gap-weighted kernel of three characters by enumeration of all subsequences."""

    def weights(w):
        out = Counter()
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < toxicity.SPAN:
                out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
        return out

    def dot(a, b):
        return sum(x * b[t] for t, x in a.items())

    a, b = weights(u), weights(v)
    size = np.sqrt(dot(a, a) * dot(b, b))
    return dot(a, b) / size if size else 0.0


def test_kernel_against_enumeration():
    rng = random.Random(4)
    landmarks = ["worthless", "grumblenitwit", "sloppyfool", "ete"]
    words = list(landmarks)
    for w in landmarks * 12:  # gaps, inserted and lost characters
        at = rng.randint(0, len(w))
        words.append(w[:at] + rng.choice(["-", "x", "..", "é", ""]) + w[at + rng.randint(0, 1) :])
    words += ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 24))) for _ in range(100)]
    got = toxicity.landmark_model(landmarks).matches(words)
    for w, row in zip(words, got, strict=True):
        for mark, value in zip(landmarks, row, strict=True):
            want = plain_kernel(w, mark)
            if abs(want - toxicity.FLOOR) > 0.04:  # codes of subsequences may collide
                assert value ** (1 / toxicity.POWER) == pytest.approx(want if want > toxicity.FLOOR else 0, abs=0.04), (w, mark)


def test_features_give_the_kernel_of_the_landmarks():
    model = toxicity.landmark_model(["worthless", "worthles", "grumblenitwit", "sloppyfool", "sloppyfools", "dullardish"])
    kernel = np.array([[plain_kernel(u, v) for v in model.landmarks] for u in model.landmarks])
    kernel = np.where(kernel > toxicity.FLOOR, kernel, 0) ** toxicity.POWER
    features = model.matches(model.landmarks) @ toxicity.whitening(model)
    assert np.allclose(features @ features.T, kernel, atol=0.03)


def test_svm_against_plain_descent():
    rng = np.random.RandomState(6)
    x = rng.randn(120, 4)
    y = np.where(x @ [1, -2, 0.5, 0] + rng.randn(120) > 0.3, 1.0, -1.0)
    cost = rng.uniform(0.1, 3, 120)

    def loss(w):
        return w[:4] @ w[:4] / 2 + 1e-6 * w[4] ** 2 / 2 + (cost * np.maximum(0, 1 - y * (x @ w[:4] + w[4])) ** 2).sum() / 2

    w, step = np.zeros(5), 1e-3
    for _ in range(20_000):
        slack = cost * np.maximum(0, 1 - y * (x @ w[:4] + w[4])) * y
        w = w - step * (np.append(w[:4], 1e-6 * w[4]) - np.append(slack @ x, slack.sum()))
    got, bias = toxicity.svm(x, y, cost)
    assert np.allclose(np.append(got, bias), w, atol=1e-3) and loss(np.append(got, bias)) <= loss(w) + 1e-6


def test_training_is_bounded(spark):
    """Rows that share a labelled id count once, and long documents give a bounded number of sentences."""
    docs = spark.createDataFrame([(1, f"{k} " + "sloppyfool here. " * 500) for k in range(50)] + [(2, "clean words only")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels)
    assert sorted((r["_id"], r["toxic"]) for r in rows.collect()) == [(1, 1), (2, 0)]
    table = toxicity.described(rows, ["sloppyfool"], {"sloppyfool"}).toArrow().sort_by([("_id", "ascending"), ("at", "ascending")])
    assert table.num_rows == toxicity.TRAIN_SENTENCES + 1


def test_gapped_words_stay_near():
    model = toxicity.Model(["worthless"], np.zeros((toxicity.TABLE, 1), np.float32), np.ones(1), 0.0, 1.0, 0.0)
    word, code, weight = toxicity.triples(["worthless"])
    model.table[code, word] = weight
    same, gapped, other = model.matches(["worthless", "worth-less", "weathers"])[:, 0]
    assert same == pytest.approx(1, abs=1e-5) and same > gapped > other


def test_spaced_and_dotted_insults(spark):
    rows = labelled(random.Random(9), 400)
    model = toxicity.fit(spark.createDataFrame(rows, "_id long, text string, toxic int"))
    insult = INSULTS[1]
    spelt = [" ".join(insult), ".".join(insult), ". ".join(insult), " . ".join(insult), "\n".join(insult), "slo.ppyfool", "slo ppy foo l", "slop!pyfool", "sl op py fo ol", "you are a s.l.o.p.p.y fo ol", "gr-umble.nitwit is what"]
    clean = ["amber basin cedar", "a b c d e f g", "it is as he and we are. So be it", "amber.Basin of cedar", "ledge! Marsh"]
    margins = toxicity.Matcher(model).documents(spelt + clean)
    said = toxicity.probabilities(model, margins) >= toxicity.THRESHOLD
    assert dict(zip(spelt + clean, said.tolist(), strict=True)) == {t: k < len(spelt) for k, t in enumerate(spelt + clean)}


def test_readings_of_short_insults():
    for t in ("i d i o t", "i.d.i.o.t", "idi.ot", "id!ot", "id iot", "an i d-i o.t", "I. D. I. O. T."):
        assert "idiot" in [w for s in toxicity.sentences_of(t) for w in s], t
    for t in ('"idiot."', "...idiot", "(idiot!) he"):
        assert "idiot" in toxicity.sentences_of(t)[0], t
    assert {"end", "next"} <= set(toxicity.sentences_of("The end.Next one")[0])


def test_toxicity_sorts_codes_only_of_words_that_may_match(monkeypatch):
    """Words that share a syllable with a landmark were all sorted and summed; those that can't reach FLOOR no longer are, with equal matches."""
    model = toxicity.landmark_model(["worthless", "pathetic", "moron", "disgusting"])
    words = ["".join("aeioulnrstmd"[(k * 7919 + j * j * 31 + k // (j + 1)) % 12] for j in range(5 + k % 9)) for k in range(3000)]
    words += ["wortless", "w0rthless", "mmoron", "moro", "pathos", "disgust", "", "ab", "abc"]
    word, code, weight = toxicity.triples(words)
    want = np.zeros((len(words), 4))
    np.add.at(want, word, model.table[code] * weight[:, None])
    sorted_words = []
    whole = toxicity.triples
    monkeypatch.setattr(toxicity, "triples", lambda some: sorted_words.extend(some) or whole(some))
    got = model.matches(words)
    assert np.allclose(got, np.where(want < toxicity.FLOOR, 0, want) ** toxicity.POWER, atol=1e-6)
    matching = (got > 0).any(1).sum()
    assert 5 <= matching <= len(sorted_words) <= matching + len(words) // 20
