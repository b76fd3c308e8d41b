"""Token counts under a unigram vocabulary, by dynamic programming along a trie.

The distinct words of a batch form a trie. The best score of a prefix, and how
many tokens reach it, depend on the prefix alone, so they are computed once per
trie node and every word below shares them; a word's count is what its last
node holds. Sorted words visit the trie in depth-first order, so only the path
from the root to the current node is kept. Counts of words seen before stay in
a table of bounded size.

Scores are log probabilities. A vocabulary file of merges holds ranks instead,
in the order of frequency; adding these up would mean nothing. They become
probabilities by Zipf's law: the piece of rank r has one in proportion to
1 / (r + 1).
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallymark.functions.names import col
from tallymark.llm.arrow import Columns, with_computed
from tallymark.llm.text import texts, words

#: What marks the start of a word in the pieces.
START = "▁"
#: An unknown character scores this much below the least piece.
UNKNOWN_PENALTY = 10.0
#: Words whose counts a worker keeps.
KEPT_WORDS = 400_000

_SCORE = ""  # key of a piece's score in its node; no character is empty


def log_probabilities(scores: list[float]) -> list[float]:
    """Scores of a vocabulary's pieces as log probabilities: as they are, or by Zipf's law where they are ranks, which are
    whole numbers. Equal scores have equal ranks, those of the first."""
    if not all(s.is_integer() for s in scores):
        return scores
    rank: dict[float, int] = {}
    for i, s in enumerate(sorted(scores, reverse=True)):
        rank.setdefault(s, i)
    whole = math.log(math.fsum(1 / (rank[s] + 1) for s in scores))
    return [-math.log(rank[s] + 1) - whole for s in scores]


class UnigramCounter:
    """Pieces and scores of a vocabulary file. A character that no piece covers is written as its UTF-8 bytes."""

    def __init__(self, model: str):
        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.root: dict = {}
        used = [
            i for i in range(pieces.get_piece_size())
            if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i) or pieces.is_unused(i))
        ]
        scores = log_probabilities([pieces.get_score(i) for i in used])
        least = min([0.0, *scores])
        for i, score in zip(used, scores):
            node = self.root
            for c in pieces.id_to_piece(i):
                node = node.setdefault(c, {})
            node[_SCORE] = score
        self.unknown = least - UNKNOWN_PENALTY
        self.counts: dict[bytes, int] = {}
        self.scores: dict[bytes, float] = {}

    def learn(self, found: Iterable[bytes]) -> None:
        """Count the distinct words ``found`` that are not known yet."""
        fresh = sorted({w.decode("utf-8", "surrogatepass") for w in found if w not in self.counts})
        if len(self.counts) + len(fresh) > KEPT_WORDS:
            self.counts.clear()
            self.scores.clear()
            fresh = sorted({w.decode("utf-8", "surrogatepass") for w in found})
        # one entry per character of the current path: best score, tokens, and pieces still under way with their start
        best, tokens = [0.0], [0]
        under_way: list[list[tuple[int, dict]]] = [[]]
        self._step(START, best, tokens, under_way)
        before = ""
        for word in fresh:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 2 :], tokens[shared + 2 :], under_way[shared + 2 :]
            for c in word[shared:]:
                self._step(c, best, tokens, under_way)
            key = word.encode("utf-8", "surrogatepass")
            self.counts[key] = tokens[-1]
            self.scores[key] = best[-1]
            before = word

    def _step(self, c: str, best: list[float], tokens: list[int], under_way: list[list[tuple[int, dict]]]) -> None:
        at = len(best) - 1
        reached = None
        count = 0
        longer = []
        for start, node in (*under_way[-1], (at, self.root)):
            node = node.get(c)
            if node is None:
                continue
            longer.append((start, node))
            score = node.get(_SCORE)
            # among equals the longest last piece stays
            if score is not None and (reached is None or best[start] + score > reached):
                reached, count = best[start] + score, tokens[start] + 1
        single = self.root.get(c)
        if (single is None or _SCORE not in single) and (reached is None or best[at] + self.unknown > reached):
            reached, count = best[at] + self.unknown, tokens[at] + len(c.encode("utf-8", "surrogatepass"))
        best.append(reached)
        tokens.append(count)
        under_way.append(longer)


@cache
def load(model: str) -> UnigramCounter:
    """The vocabulary at ``model``, once per worker."""
    return UnigramCounter(model)


def count_tokens(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``n_words``, ``n_tokens`` and ``token_score`` (sum of the words' best scores).

    ``model`` is a file that every worker can open. NULL and empty texts have no
    tokens; repeated rows count alike; a single word of any length is one path
    of the trie. Columns of ``docs`` called like a result column are replaced;
    an empty table gives an empty result.
    """
    def start():
        counter = load(model)

        def compute(columns: Columns) -> Columns:
            found = [words(t) for t in texts(columns[0])]
            counter.learn({w for ws in found for w in ws})
            counts, scores = counter.counts.__getitem__, counter.scores.__getitem__
            return [
                pa.array([len(ws) for ws in found], pa.int64()),
                pa.array([sum(map(counts, ws)) for ws in found], pa.int64()),
                pa.array([float(sum(map(scores, ws))) for ws in found], pa.float64()),
            ]

        return compute

    schema = "n_words bigint, n_tokens bigint, token_score double"
    return with_computed(docs, [col(text_col).cast("string")], schema, start)
