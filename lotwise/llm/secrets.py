"""Secret scan: keyword automaton, anchored patterns near hits, embedded checksums.

One Aho-Corasick pass over the text finds every keyword; an anchored pattern is
tried only where a keyword was hit. Runs of hex digits have no keyword, so one
linear pattern finds them. Kinds with an embedded checksum count only when the
checksum holds.

Rows are independent: each input row gives one output row, equal or repeated ids
included. A null or empty text has no spans; a very long one is read whole, in time
proportional to its length. Positions count code points, end exclusive. Spans that start
together come in the listed order of kinds. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ASCII_LOWER

# Kinds in their listed order; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE = 3
# Keywords, lower-case, with the kind whose pattern starts there.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "apikey": "assign", "api_key": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt", "-----begin": "pem",
}
PATTERNS = {
    "assign": re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "pem": re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
}
#: A token's header run and what follows it.
RUN, TAIL = re.compile(r"[A-Za-z0-9_-]*"), re.compile(r"\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
HEX = re.compile(r"[0-9a-f]{16,}")
END = re.compile(r"[ \t\n\r]*\Z")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long"


def base62(n: int, width: int) -> str:
    out = ""
    for _ in range(width):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


def _crc_suffix(m: re.Match) -> bool:
    return base62(binascii.crc32(m[1].encode()), 6) == m[2]


VALID = {
    "assign": lambda m: len(m[1]) >= 12,
    "access": lambda m: len(m[0]) >= 18,
    "github": _crc_suffix,
    "npm": _crc_suffix,
    "pem": lambda m: True,
}


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


class Headers:
    """Which starts in a run of token characters open a token whose header is JSON with an algorithm.

    Starts that lie four characters apart decode alike, so a run is decoded four times at most, however many starts it has.
    """

    def __init__(self, text: str, start: int):
        self.text, self.end = text, RUN.match(text, start).end()
        tail = TAIL.match(text, self.end)
        self.token_end, self.decoded = tail and tail.end(), {}

    def holds(self, start: int) -> bool:
        if self.token_end is None or self.end - start < 4:
            return False
        first, header = self.decoded.setdefault(start % 4, (start, None))
        if header is None:
            run = self.text[start : self.end]
            try:
                header = base64.urlsafe_b64decode(run + "=" * (-len(run) % 4)).decode("latin-1")
            except ValueError:
                header = ""
            self.decoded[start % 4] = first, header
        at = (start - first) // 4 * 3
        try:
            value, end = json.JSONDecoder().raw_decode(header, at)
            return "alg" in value and bool(END.match(header, end)) and bool(header[at:].encode("latin-1").decode())
        except (ValueError, TypeError, RecursionError):  # no JSON, a number, bytes that are no text, or brackets in brackets without end
            return False


def tokens_of(text: str, starts: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the tokens with a valid header, leftmost first, that begin at one of the starts."""
    out, end, run = [], 0, None
    for start in starts:
        if start < end or not text.startswith("eyJ", start):
            continue
        if run is None or start >= run.end:
            run = Headers(text, start)
        if run.holds(start):
            end = run.token_end
            out.append((start, end))
    return out


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind index, end), by start, then kind as listed."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer moves the positions
        low = text.translate(ASCII_LOWER)
    spans, hits = [], {}
    for at, (length, kind) in automaton().iter(low):
        hits.setdefault(kind, []).append(at - length + 1)
    for kind, starts in hits.items():
        k = KINDS.index(kind)
        if kind == "jwt":
            spans += [(start, k, end) for start, end in tokens_of(text, sorted(starts))]
            continue
        end, pattern, valid = 0, PATTERNS[kind], VALID[kind]
        for start in sorted(starts):
            if start < end or not (m := pattern.match(text, start)):
                continue
            good = valid(m)
            if good:
                spans.append((start, k, m.end()))
            if good or k < BASE:  # a base match takes its characters even if its check fails
                end = m.end()
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    spans.sort()
    return spans


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans, their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan(x.as_py()) for x in b.column("text")]
            base = [[s for s in spans if s[1] < BASE] for spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").cast(pa.int64()),
                    *(pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(BASE)),
                    pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base], pa.string()),
                    pa.array([joined(spans) for spans in found], pa.string()),
                    pa.array([len(spans) for spans in found], pa.int64()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


#: DuckDB SQL for the counts of the base kinds over documents.
COUNTS_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id,
  len(list_filter(regexp_extract_all(t, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda x: length(x) >= 12)) AS n_assign,
  len(list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS n_access,
  len(regexp_extract_all(t, '[0-9a-f]{16,}')) AS n_hex
FROM t
"""
