"""BPE encoding and decoding with a contiguous rank array.

A word is its characters' boundaries and the ranks of the pairs that meet at
each of them, in two plain lists. The smallest rank is looked for by a scan, its
boundary is deleted and the ranks of the two neighbours are looked up anew. For
a short word that beats any heap; a run of thousands of characters without a
break would make it quadratic, so such a word goes through a heap of pairs that
merges in the same order. Words repeat, so each worker keeps what it has encoded
in a table of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymark.functions.names import col
from tallymark.llm.arrow import Columns, with_computed
from tallymark.llm.text import texts

_NO_RANK = 1 << 60
#: Words of more characters than this go through the heap.
SHORT_WORD = 256
#: Encoded words that a worker keeps.
KEPT_WORDS = 300_000


def _byte_symbols() -> list[str]:
    """The printable character that byte-level BPE writes for each byte: bytes that print stand for themselves, the
    others take the code points from 256 on in order."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(spare)) for b in range(256)]


# Code points with Unicode's property White_Space, as members of a character class.
_WHITE_SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _members(kind: str) -> str:
    """The code points of a general category's first letter, as members of a character class."""
    points = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == kind]
    firsts = [c for c, b in zip(points, [-2, *points]) if c != b + 1]
    lasts = [c for c, b in zip(points, [*points[1:], -2]) if c != b - 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts))


class WordBpe:
    """A BPE vocabulary with word ends, read from a tokenizer file: text is NFC, lower case, and white space goes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in (*self.ids.items(), *self.special.items())}
        self.tokens = np.array([by_id.get(i, "") for i in range(max(by_id) + 1)], object)
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for name, members in (("\\p{L}", _members("L")), ("\\p{N}", _members("N")), ("\\s", _WHITE_SPACE)):
            pattern = pattern.replace(name, members)
        self.word = re.compile(pattern)
        self.symbols = _byte_symbols()
        self.known: dict[str, bytes] = {}

    # -- one word ---------------------------------------------------------------------

    def merge(self, parts: list[str]) -> list[str]:
        """Merge the parts of a word, smallest rank first, leftmost among equals."""
        if len(parts) > SHORT_WORD:
            return self._merge_long(parts)
        ranks = self.ranks
        near = [ranks.get(pair, _NO_RANK) for pair in zip(parts, parts[1:])]
        while near:
            least = min(near)
            if least == _NO_RANK:
                break
            i = near.index(least)
            parts[i] += parts[i + 1]
            del parts[i + 1], near[i]
            if i < len(near):
                near[i] = ranks.get((parts[i], parts[i + 1]), _NO_RANK)
            if i:
                near[i - 1] = ranks.get((parts[i - 1], parts[i]), _NO_RANK)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        following = [*range(1, len(parts)), -1]
        previous = [*range(-1, len(parts) - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := self.ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = following[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, ""
            following[i] = k = following[j]
            if k >= 0:
                previous[k] = i
            for a, b in ((previous[i], i), (i, k)):
                if a >= 0 and b >= 0 and (r := self.ranks.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return [p for p in parts if p]

    def _encode_word(self, word: str) -> bytes:
        parts = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        parts[-1] += self.end
        found = self.merge(parts)
        entry = struct.pack(f"<{len(found)}I", *map(self.ids.__getitem__, found))
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        self.known[word] = entry
        return entry

    # -- texts ---------------------------------------------------------------------------

    def _words(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # capital sigma on its own: str.lower() would write a final sigma at word ends
        return self.word.findall(text.replace("Σ", "σ").lower())

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        ids: list[bytes] = []
        known = self.known
        for piece in self.special_at.split(text) if "<|" in text else (text,):
            if piece in self.special:
                ids.append(struct.pack("<I", self.special[piece]))
                continue
            for word in self._words(piece):
                ids.append(known.get(word) or self._encode_word(word))
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """The text of ids: their tokens joined by spaces, special tokens included."""
        return " ".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


@cache
def load(path: str) -> WordBpe:
    """The vocabulary at ``path``, once per worker."""
    return WordBpe(path)


def encode_decode(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``n_tokens``, ``token_ids`` (packed little-endian unsigned 32-bit) and ``decoded``.

    ``vocabulary`` is a file that every worker can open. A NULL text is an empty
    one, which has no tokens; special tokens' strings in a text become their
    ids. Repeated rows are encoded alike. Columns of ``docs`` called like a
    result column are replaced; an empty table gives an empty result.
    """
    def start():
        bpe = load(vocabulary)

        def compute(columns: Columns) -> Columns:
            done = [bpe.encode(t) for t in texts(columns[0])]
            return [
                pa.array([len(ids) // 4 for ids in done], pa.int64()), pa.array(done, pa.binary()),
                # read back from the ids, as a reader of the result would
                pa.array([bpe.decode(ids) for ids in done], pa.string()),
            ]

        return compute

    schema = "n_tokens bigint, token_ids binary, decoded string"
    return with_computed(docs, [col(text_col).cast("string")], schema, start)
