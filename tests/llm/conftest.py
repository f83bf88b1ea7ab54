import random

import pytest

#: Columns of documents, and others whose names the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, row string, key string, size long, line string, word string, copies long, rate double, slot int, shard int, "
    "band long, rep long, c long, n long, class string, bucket int, next long, mark long, target double, at int, unit string, range int"
)
WORDS = "amber basin cedar delta ember fjord grove heath inlet jetty knoll ledge marsh north ocean plain quarry ridge shore tarn upland vale wharf yield zenith".split()
LINE = "This licence line is repeated in many documents of the corpus."


def rows_of(pairs):
    """Full rows of (doc_id, text, source) triples; the extra columns hold noise."""
    return [(d, t, "en", s, None if t is None else len(t), 1, "r", "k", 2, "l", "w", 3, 0.5, 4, 5, 6, 7, 8, 9, "c", 10, 11, 12, 0.1, 13, "u", 14) for d, t, s in pairs]


def prose(rng, n):
    return " ".join(rng.choice(WORDS).capitalize() if rng.random() < 0.1 else rng.choice(WORDS) for _ in range(n))


def corpus():
    rng = random.Random(5)
    out = []
    for d in range(60):
        lines = [prose(rng, rng.randint(3, 30)) + "." for _ in range(rng.randint(1, 6))]
        if d % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), ("  " if d % 8 else "\t") + LINE.upper() + " ")
        out.append((d * 3, "\n".join(lines), f"s{d % 3}"))
    base = prose(rng, 80)
    for k in range(8):  # near copies in a chain: one word more is changed each time
        words = base.split()
        for j in range(k):
            words[7 * j + 3] = f"changed{j}"
        out.append((200 + k, " ".join(words), "s0"))
    out += [(300 + k, "Exactly the same short text", "s1") for k in range(5)]
    out += [(400, None, "s1"), (401, "", "s2"), (402, " \t\n\x0b ", None), (403, "one", None), (404, "Îles Été ÉTÉ straße İstanbul\nÉtoile", "é")]
    out += [(405, prose(rng, 6000), "s0"), (None, "a text whose id is null and nothing else", "s1")]
    out += [out[0], out[0]]  # repeated rows
    return out


@pytest.fixture(scope="session")
def triples():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, triples):
    return spark.createDataFrame(rows_of(triples), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
