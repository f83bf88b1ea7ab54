"""Spelling variants, conversation repair and license scan against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

from lotwise.llm import conversations, licenses, spelling
from tests.llm.conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- spelling


def plain_counts(pairs):
    out = Counter()
    for d, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        near = sorted(((-words[x], x) for x in words if is_near(w, x)))
        formed = bool(near) and -near[0][0] >= 2 * n
        out[w] = [near[0][1] if formed else None, None, n, len(near), -near[0][0] if formed else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return out


def spelled(seed):
    """Texts of words over few letters, near one another in every way, in counts that chain."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abn") for _ in range(rng.choice((5, 5, 5, 6, 8)))) for _ in range(150)} | {"aaaaa", "aaaaaa", "bananas", "ß÷×ßß", "éabnn"}
    out = []
    for k, w in enumerate(sorted(words)):
        out += [(k, " ".join([w if rng.random() < 0.8 else w.capitalize()] * 2 ** rng.randint(0, 6)), "s")]
    return [*out, (None, "aaaaa AAAAA aaaab", "s"), (1, None, "s"), (2, "", "s"), (3, "1 2 3 - \n", None), out[0], out[0]]


def test_spelling_variants_agree_with_all_pairs(spark, nothing):
    for seed in (1, 2):
        rows = spelled(seed)
        docs = spark.createDataFrame(rows_of(rows), nothing.schema).repartition(3)
        found = {r["word"]: [r["form"], r["root"], r["n"], r["n_near"], r["form_n"]] for r in spelling.variants(docs).collect()}
        want = plain_variants(plain_counts([(d, t) for d, t, _ in rows]))
        assert found == want
        assert any(r[1] != r[0] and r[0] for r in want.values())  # chains of two steps or more
    assert spelling.variants(nothing).count() == 0


def test_no_join_of_words_goes_through_the_driver(spark, nothing, monkeypatch):
    """The index was estimated at the size of the words' file, so 805 MB were broadcast for 0.5 GB of documents."""
    plans, cut = [], spelling.cut

    def seen(df, *names):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, *names)

    monkeypatch.setattr(spelling, "cut", seen)
    out = spelling.variants(spark.createDataFrame(rows_of(spelled(4)), nothing.schema))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and not any("Broadcast" in p for p in plans)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(400):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 12)))
        rank = {a + b: k for k, (a, b) in enumerate(rng.sample(list(itertools.product("abcd", repeat=2)), 16))}
        prefix, last, left, right = spelling.prefix_and_pivots(word, rank)
        grams = [rank[word[k : k + 2]] for k in range(len(word) - 1)]
        assert last == sorted(grams)[2] and prefix == [k for k, g in enumerate(grams) if g <= last]
        assert left in prefix and right in prefix and right - left >= 2
        assert grams[left] + grams[right] == min(grams[a] + grams[b] for a in prefix for b in prefix if b - a >= 2)


def test_near_words_meet_under_a_key():
    """Every edit of a word leaves a common key in one direction, whatever the ranks."""
    rng = random.Random(4)
    pairs = ["".join(p) for p in itertools.product("abcd", repeat=2)]
    for _ in range(300):
        rank = {p: k for k, p in enumerate(rng.sample(pairs, 16))}
        x = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 9)))
        k = rng.randrange(len(x) + 1)
        y = rng.choice([x[:k] + rng.choice("abcd") + x[k:], x[:k] + x[k + 1 :], x[:k] + rng.choice("abcd") + x[k + 1 :]])
        if x == y or len(y) < 5:
            continue
        meet = False
        for a, b in ((x, y), (y, x)):
            _, a_last, left, right = spelling.prefix_and_pivots(a, rank)
            prefix, b_last, _, _ = spelling.prefix_and_pivots(b, rank)
            meet |= a_last <= b_last and bool(spelling.pivot_keys(a, left, right) & spelling.prefix_keys(b, prefix))
        assert meet, (x, y)


# --- conversations

LEGAL = re.compile("(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string, code string, times long, best string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-")
        seen.add((role, text))
    return out


def plain_best(rows, faults):
    """Least (cost, audit) with its lines, over all edits row by row; the least of each role state goes on."""
    def inserts(initials):
        yield "", ""
        yield "I", "u" if initials[-1:] != "u" else "a"
        if initials[-1:] in ("", "s"):
            yield "II", "ua"

    names = {"u": "user", "a": "assistant"}

    def inserted(held):
        out = {}
        for initials, (cost, audit, lines) in held.items():
            for letters, more in inserts(initials):
                state = (initials + more)[-2:]
                new = (cost + 5 * len(letters), audit + letters, [*lines, *(names[m] + ":" for m in more)])
                out[state[-1:]] = min(out.get(state[-1:], new), new)
        return out

    held = {"": (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults):
        out = {}

        def put(state, new):
            out[state] = min(out.get(state, new), new)

        for state, (cost, audit, lines) in inserted(held).items():
            put(state, (cost + 2, audit + "D", lines))
            if fault in "bd":
                continue
            more = 5 if fault == "t" else 0
            if (i := role[:1]) in ("s", "u", "a") and LEGAL.fullmatch(state + i + ("" if i == "a" else "a" if i == "u" else "ua")) or (state, i) in (("u", "a"), ("a", "u")):
                put(i, (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            to = "a" if state == "u" else "u"
            put(to, (cost + more + 1, audit + "R", [*lines, f"{names[to]}:{text}"]))
        held = out
    return min(v for s, v in inserted(held).items() if s in ("", "a"))


def plain_repair(rows):
    out = {conv: None for conv, *_ in rows}
    groups = {}
    for r in plain_damage(rows):
        groups.setdefault(r[0], []).append(r)
    for conv in out:
        held = sorted(groups.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = plain_faults(held)
        turns = [r[1] for r in held if r[1] is not None]
        initials = [r[2][:1] for r in held]
        cost, audit, lines = plain_best(held, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(k) for k in "bdt"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def talk(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "Assistant"]
    texts = ["One thing.", "Is it so?", "No", "cut off in", " \t", "", None, "Yes!\n", "One thing.", "Déjà vu…", "last mark!\x0b "]
    out = []
    for conv in [*range(60), None]:
        for _ in range(rng.randint(1, 9)):
            out.append((conv, rng.choice([None, *range(-2, 12)]), rng.choice(roles[: rng.choice([2, 4, 10])]), rng.choice(texts)))
    return out + [(100, k, "user" if k % 2 else "assistant", f"Line {k % 97}.") for k in range(700)] + [(101, 0, "user", "same.")] * 9


def test_conversations_agree_with_the_cheapest_edits(spark):
    for seed in (1, 2):
        rows = talk(seed)
        df = spark.createDataFrame([(*r, "c", 9, "b") for r in rows], ROWS).repartition(3)
        found = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in conversations.repaired(conversations.damaged(df)).collect()}
        assert found == plain_repair(rows)
    assert conversations.repaired(conversations.damaged(spark.createDataFrame([], ROWS))).count() == 0


def test_search_agrees_with_enumeration():
    """All edits with two inserts in a row at most, tried one by one."""
    rng = random.Random(7)
    for _ in range(60):
        codes = ["".join(rng.choice(p) for p in ("suua-", "--tbd")) for _ in range(rng.randint(0, 4))]
        best = None
        for letters in itertools.product("DKR", repeat=len(codes)):
            for gaps in itertools.product(("", "I", "II"), repeat=len(codes) + 1):
                audit, state, cost = gaps[0], "", 5 * sum(map(len, gaps))
                roles = ["I" * len(gaps[0])]
                legal = True
                for code, letter, gap in zip(codes, letters, gaps[1:]):
                    audit += letter + gap
                    legal &= letter == "D" or code[1] not in "bd"
                    cost += {"D": 2, "K": 0, "R": 1}[letter] + (5 if code[1] == "t" and letter != "D" else 0)
                    roles += [code[0] if letter == "K" else "I" if letter == "R" else "", "I" * len(gap)]
                for r in "".join(roles):  # I stands for the role that fits
                    state += r if r != "I" else "a" if state[-1:] == "u" else "u"
                if legal and LEGAL.fullmatch(state) and (best is None or (cost, audit) < best):
                    best = cost, audit
        assert conversations.search(codes, 0, conversations.ENDS) == best
        for block in (1, 2, 3):
            pieces = conversations.Search(block)
            for code in codes:
                pieces.add(code)
            assert pieces.answer() == best


# --- licenses


def plain_scan(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    places = sorted((k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
    starts = [k for k, _ in places]
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_license_scan(spark, triples, nothing):
    rng = random.Random(5)
    mit = next(t for t, label in licenses.NOTICES.items() if label == "mit-text")
    bent = mit.replace("free of charge", "free and without any charge").replace("granted", "given")
    vocabulary = "gnu general public license apache cc by mit the of Straße 4.0".split()
    texts = [
        None, "", "cc", "cc by", "CC-BY-CC/by", "cc by cc by cc by", "MIT  License\n" * 400, "GNU General\tPublic, License, and Apache_License", "mit licenses", "\x00cc\x00byé", "ccby \U0001f600cc by",
        "Prose before. " + mit.upper() + " prose after.", "x " + bent + " y", mit[:40], " ".join(mit.split()[::-1]), "word " * 5000 + "apache license",
        *(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(60)),
    ]
    rows = [(k % 50, t, "s") for k, t in enumerate(texts)] + [(None, "cc by", "s")] * 3
    found = licenses.scan(spark.createDataFrame(rows_of(rows), nothing.schema).repartition(4)).collect()
    want = sorted(repr((d, *plain_scan(t))) for d, t, _ in rows)
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) for r in found) == want
    for r in found:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert licenses.scan(nothing).count() == 0


def test_notices_are_found_with_words_changed(spark):
    mit = next(t for t, label in licenses.NOTICES.items() if label == "mit-text")
    bent = mit.replace("free of charge", "free and without any charge").replace("granted", "given")
    rows = [(1, mit), (2, "Before it. " + bent + " After it."), (3, " ".join(mit.split()[::-1])), (4, "permission is hereby granted to any person who asks"), (5, " filler ".join(mit.split()))]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["labels"] == "mit-text" and found[1]["score"] == 1
    assert found[2]["labels"] == "mit-text" and 0.6 <= found[2]["score"] < 1
    assert all(found[k]["labels"] == "" for k in (3, 4, 5)) and found[5]["score"] == 0
