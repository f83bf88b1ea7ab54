"""Token ids of whole texts with a public tokenizer, word by word.

The word tokenizer never joins text across white space, so the ids of a text are
the ids of its white-space-separated words in order. Arrow finds the distinct words
of a batch of texts. A word of printable ASCII and Latin letters needs no normalising but
lower case: the tokenizer's own pattern cuts it into pieces, and the tokenizer's model
encodes a piece. Any other word goes through the whole tokenizer. Each worker keeps bounded tables of
the words and pieces it met last.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

TOKENIZER = "word_bpe_49k.json"
END = 2
#: Words and pieces in each of the two generations of a worker's tables; bound its memory.
KEPT_WORDS, KEPT_PIECES = 250_000, 200_000
#: Code points whose letters need only lower case: ASCII, Latin-1 and Latin Extended-A.
LATIN = range(0x180)

_loaded: dict[str, WordIds] = {}


class Recent:
    """Table of the keys met last. What was met since the last change of generations is young; the old goes with the next change."""

    def __init__(self, kept: int):
        self.kept, self.young, self.old = kept, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.kept:
            self.old, self.young = self.young, {}
        self.young[key] = value


class WordIds:
    def __init__(self, path: str, kept_words: int = KEPT_WORDS, kept_pieces: int = KEPT_PIECES):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        made = json.loads(self.tokenizer.to_str())
        steps = made["pre_tokenizer"]["pretokenizers"]
        lowers = [n["type"] for n in made["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        if not (lowers and [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"]):
            raise ValueError(f"{path} does not lower, cut and map words as the word tokenizer does")
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        normal = {c: self.tokenizer.normalizer.normalize_str(c) for c in map(chr, LATIN) if c.isalpha()}
        normal = {c: n for c, n in normal.items() if len(n) == 1 and n.isalpha()}
        self.lower = str.maketrans(normal)
        self.bytewise = str.maketrans({n: bytewise(n)[0][0] for n in normal.values()})
        letters = "".join(sorted(set(normal.values())))
        # Of plain words in lower case, \p{L} and \p{N} are these.
        self.cut = re.compile(steps[0]["pattern"]["Regex"].replace(r"\p{L}", letters).replace(r"\p{N}", "0-9")).findall
        self.odd = re.compile("|".join([f"[^!-~{''.join(normal)}]", *(re.escape(t["content"]) for t in made["added_tokens"])])).search
        self.words, self.pieces = Recent(kept_words), Recent(kept_pieces)

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = array("I", [t.id for t in self.model.tokenize(piece.translate(self.bytewise))]).tobytes()
            self.pieces.put(piece, found)
        return found

    def _word(self, word: str) -> bytes:
        if self.odd(word):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        pieces = self.cut(word.translate(self.lower))
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self._piece, pieces))

    def _words(self, words: list[str]) -> list[bytes]:
        found = list(map(self.words.young.get, words))
        for k, ids in enumerate(found):
            if ids is None:
                if (ids := self.words.old.get(words[k])) is None:
                    ids = self._word(words[k])
                found[k] = ids
                self.words.put(words[k], ids)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and where each text's ids start (and the last one's end)."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        known = self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts, flat = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(known), "<u4")
        at = coded.indices.to_numpy()
        lengths = lengths[at]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        ids = flat[np.repeat(starts[at] - ends[:-1], lengths) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
