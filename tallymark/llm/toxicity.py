"""Toxicity by noisy-channel deobfuscation.

Disguised words (digits and signs for letters, letters spaced out, letters
repeated) are read as a lattice of what each character may stand for, and the
path that a character model of the corpus finds likeliest is taken. The
restored words are then scored: each whole word and each beginning of a word
that labelled toxic documents use, and clean ones hardly, is evidence, and a
document's score joins the evidence of its distinct words.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm.arrow import Columns, with_computed
from tallymark.llm.text import mix64, slices, texts, windows, words

# What signs are commonly written for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i",
    "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "*": "aeiou", "#": "h", "%": "o", "&": "e",
}
# Letters of other scripts that look like Latin ones, read so in words that also have Latin letters.
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "ѵ": "v", "х": "x", "у": "y", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x",
})
_LATIN = re.compile("[a-z]")
_CLOSING = ".,;:!?)\"'»”’…"
_OPENING = "(\"'«“‘¡¿"
_PLAIN = re.compile(r"[^\W\d_]+")
_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"([^\W\d_])\1")
_LONG_RUN = re.compile(r"(.)\1{3,}", re.S)
_NUMBER = re.compile(r"[$€£¥#+-]?\d[\d.,:/-]*%?")
_LONE = ".,;:-_'\""
_EDGE_RUN = re.compile(r"^(?:([^\w])\1+)+|(?:([^\w])\2+)+$")

#: Characters of the model: code points below this one, all letters above it being one.
ALPHABET = 0x250
_BOUNDARY = 0
_KEPT_TOKENS = 400_000


# -- character model --------------------------------------------------------------------------


@dataclass(frozen=True)
class CharModel:
    """Log probabilities of a character after another, within and around words."""

    log_p: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> CharModel:
        seen = counts.sum(axis=1, keepdims=True)
        alone = counts.sum(axis=0) + 0.01
        alone = alone / alone.sum()
        # each row leans on the character's own frequency
        return cls(np.log((counts + 5.0 * alone) / (seen + 5.0)).astype(np.float32))


def _symbols(text: str) -> np.ndarray:
    """Each letter as its number, everything else as a boundary."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return _letter_table()[np.minimum(points, ALPHABET)]


_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        table = np.array([c if chr(c).isalpha() else _BOUNDARY for c in range(ALPHABET + 1)], np.int64)
        table[ALPHABET] = ALPHABET - 1
        _LETTERS.append(table)
    return _LETTERS[0]


def bigram_counts(text: str) -> np.ndarray:
    """Counts of neighbouring symbols of a text, boundaries around it included, as one flat table."""
    s = np.concatenate([[_BOUNDARY], _symbols(text), [_BOUNDARY]])
    keys = s[:-1] * ALPHABET + s[1:]
    return np.bincount(keys[keys > 0], minlength=ALPHABET * ALPHABET)


# -- restoring ----------------------------------------------------------------------------------

#: A word with so many doubled letters, which make up this share of it, is read as one that may have been stretched.
STRETCHED, STRETCHED_SHARE = 3, 0.75


def fold(token: str) -> str:
    """A lower-case word without accents, in letters of common width, and without Latin letters' doubles from other scripts."""
    if token.isascii():
        return token
    marks = unicodedata.normalize("NFKD", token)
    bare = unicodedata.normalize("NFC", "".join(c for c in marks if not unicodedata.combining(c))).lower()
    return bare.translate(HOMOGLYPHS) if _LATIN.search(bare) else bare


class Restorer:
    """Reads disguised words under a character model."""

    # log costs of the channel
    STANDS_FOR = -1.5
    LEFT_OUT = -2.5
    UNREAD = -9.0
    # log costs of what is no word: a digit of a number, a random string and each of its characters
    DIGIT = float(np.log(1 / 10))
    RANDOM = -6.0
    ANY = float(np.log(1 / 36))
    # log cost of a word break among lone characters, and gain for each letter of a known word
    BREAK = -1.5
    KNOWN = 1.0

    def __init__(self, model: CharModel):
        self.model = model

    def _arcs(self, c: str, last: bool) -> list[tuple[str, float]]:
        if c.isalpha():
            return [(c, 0.0)]
        arcs = [(letter, self.STANDS_FOR) for letter in LOOKALIKES.get(c, "")]
        if not c.isdigit():
            # a sign that looks like a letter is seldom mere decoration
            cost = self.LEFT_OUT / 2 if last else self.LEFT_OUT * (2 if arcs else 1)
            arcs.append(("", cost))
        return arcs or [("", self.UNREAD)]

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each position the readings and their costs; a run of three or more is one position, and so is a doubled letter
        of a word with several."""
        stretched = _is_stretched(token)
        out = []
        i = 0
        while i < len(token):
            j = i
            while j < len(token) and token[j] == token[i]:
                j += 1
            if j - i >= 3 or j - i == 2 and stretched and token[i].isalpha():
                arcs = self._arcs(token[i], j == len(token))
                out.append([(letters * n, cost * n + extra) for letters, cost in arcs for n, extra in ((1, -0.5), (2, -0.7))])
            else:
                out += [self._arcs(token[i], j == len(token))] * (j - i)
            i = j
        return out

    def viterbi(self, token: str) -> tuple[str, float]:
        """The likeliest reading and its log probability: states are the last letter written."""
        log_p = self.model.log_p
        states: dict[int, tuple[float, list]] = {_BOUNDARY: (0.0, None)}
        for arcs in self.lattice(token):
            reached: dict[int, tuple[float, list]] = {}
            for last, (score, path) in states.items():
                for letters, cost in arcs:
                    total, at = score + cost, last
                    for c in letters:
                        symbol = min(ord(c), ALPHABET - 1)
                        total += float(log_p[at, symbol])
                        at = symbol
                    if at not in reached or total > reached[at][0]:
                        reached[at] = (total, (path, letters) if letters else path)
            states = reached
        best = max(states.items(), key=lambda s: s[1][0] + float(log_p[s[0], _BOUNDARY]))
        path, parts = best[1][1], []
        while path is not None:
            path, letters = path
            parts.append(letters)
        return "".join(reversed(parts)), best[1][0] + float(log_p[best[0], _BOUNDARY])

    def no_word(self, token: str) -> float:
        """Log probability as a number or a random string."""
        if _NUMBER.fullmatch(token):
            return self.DIGIT * len(token)
        return self.RANDOM + self.ANY * len(token)

    def restore(self, token: str) -> str:
        """A lower-case word without its disguise; empty if it is likelier a number or a random string."""
        token = fold(token)
        if _is_plain(token):
            return token
        core = _EDGE_RUN.sub("", _LONG_RUN.sub(r"\1\1\1", token)).rstrip(_CLOSING).lstrip(_OPENING)
        core = _EDGE_RUN.sub("", core)
        if _is_plain(core):
            return core
        if not any(c.isalpha() or c in LOOKALIKES for c in core):
            return ""
        reading, score = self.viterbi(core)
        letters = sum(map(str.isalpha, core))
        if letters >= 2 and 2 * letters >= len(core):
            return reading
        return reading if score > self.no_word(core) else ""

    def known_in(self, run: str, evidence: dict[str, float], beginnings: frozenset[str]) -> set[str]:
        """The words and stems of ``evidence`` on the likeliest path through a run of lone characters, each blank of which
        may be a word break."""
        log_p = self.model.log_p
        at: list[dict[int, tuple[float, tuple | None]]] = [{} for _ in range(len(run) + 1)]
        at[0][_BOUNDARY] = (0.0, None)
        arcs = [self._arcs(c, i == len(run) - 1) for i, c in enumerate(run)]

        def put(i: int, symbol: int, score: float, path: tuple | None) -> None:
            if symbol not in at[i] or score > at[i][symbol][0]:
                at[i][symbol] = (score, path)

        for i in range(len(run)):
            for last, (score, path) in list(at[i].items()):
                if last != _BOUNDARY:
                    put(i, _BOUNDARY, score + float(log_p[last, _BOUNDARY]) + self.BREAK, path)
            for last, (score, path) in at[i].items():
                for letter, cost in arcs[i]:
                    symbol = min(ord(letter), ALPHABET - 1) if letter else last
                    put(i + 1, symbol, score + cost + (float(log_p[last, symbol]) if letter else 0.0), path)
            if _BOUNDARY not in at[i]:
                continue
            begun, path = at[i][_BOUNDARY]
            open_ = [(i, "", _BOUNDARY, begun)]
            while open_:
                j, word, last, score = open_.pop()
                for feature in (word + " ", word):
                    if feature in evidence:
                        put(j, last, score + self.KNOWN * len(word), (path, feature))
                for letter, cost in arcs[j] if j < len(run) else ():
                    if word + letter in beginnings:
                        symbol = min(ord(letter), ALPHABET - 1) if letter else last
                        gain = cost + (float(log_p[last, symbol]) if letter else 0.0)
                        open_.append((j + 1, word + letter, symbol, score + gain))
        best = max(at[-1].items(), key=lambda s: s[1][0] + float(log_p[s[0], _BOUNDARY]))
        path, out = best[1][1], set()
        while path is not None:
            path, feature = path
            out.add(feature)
        return out


def _is_plain(token: str) -> bool:
    """Whether a word stands for itself: letters alone, none stretched."""
    return bool(_PLAIN.fullmatch(token)) and not _TRIPLE.search(token) and not _is_stretched(token)


def _is_stretched(token: str) -> bool:
    doubled = len(_DOUBLE.findall(token))
    return doubled >= STRETCHED and 2 * doubled >= STRETCHED_SHARE * len(token)


def _lone(word: str) -> str:
    """The one character of a word, points around it aside; empty if it has more."""
    if len(word) == 1:
        return word
    inner = word.strip(_LONE)
    if len(inner) != 1:
        inner = word.rstrip(_CLOSING).lstrip(_OPENING)
    return inner if len(inner) == 1 else ""


def spaced_runs(found: list[str]) -> list[str]:
    """Runs of three or more single characters, each put together."""
    out, run = [], []
    for word in (*found, ""):
        c = _lone(word)
        if c:
            run.append(c)
            continue
        if len(run) >= 3:
            out.append("".join(run))
        run = []
    return out


def join_spaced(found: list[str]) -> list[str]:
    """Words, with runs of single characters put together to one more word each."""
    return [*found, *spaced_runs(found)]


# -- evidence -------------------------------------------------------------------------------------

#: Characters of a beginning.
STEMS = range(3, 9)


def features(word: str) -> list[str]:
    """A restored word, marked by a blank at its end, and its beginnings."""
    if len(word) < 3:
        return []
    return [word + " ", *(word[:n] for n in STEMS if n < len(word))]


@dataclass(frozen=True)
class ToxicityModel:
    """Evidence of words (marked by a blank) and stems, the score of a document without any, and the letters."""

    evidence: dict[str, float]
    base: float
    chars: CharModel


class Scorer:
    """Scores texts; a worker keeps the evidence of the tokens it has met, up to a bound."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.restorer = Restorer(model.chars)
        self.known: dict[str, float] = {}
        self.beginnings = frozenset(f[:n] for f in model.evidence for n in range(len(f.rstrip(" ")) + 1))

    def evidence(self, token: str) -> float:
        got = self.known.get(token)
        if got is None:
            word = self.restorer.restore(token)
            got = max((self.model.evidence.get(f, 0.0) for f in features(word)), default=0.0)
            if len(self.known) >= _KEPT_TOKENS:
                self.known.clear()
            self.known[token] = got
        return got

    def _spaced(self, runs: set[str]) -> list[float]:
        """Evidence of the distinct words in runs of lone characters: of those known, else of the run as one word."""
        known, whole = set(), []
        for run in runs:
            inside = self.restorer.known_in(run, self.model.evidence, self.beginnings)
            known |= inside
            if not inside:
                whole.append(self.evidence(run))
        return [*(self.model.evidence[f] for f in sorted(known)), *sorted(e for e in whole if e)]

    def score(self, text: str) -> float:
        found = [w.decode("utf-8", "surrogatepass") for w in words(text.lower())]
        clean = 1.0 - self.model.base
        for e in map(self.evidence, {*found}):
            if e:
                clean *= 1.0 - e
        for e in self._spaced({*spaced_runs(found)} - {*found}):
            clean *= 1.0 - e
        return 1.0 - clean


# -- learning ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Learning:
    """Bounds and thresholds of the fit."""

    #: labelled rows that teach: beyond this number, a random part of them by hash of the id
    max_labels: int = 200_000
    #: a word or stem is evidence from so many toxic documents on, and this share of all toxic ones
    least_documents: int = 4
    least_share: float = 0.003
    #: of the documents that have it, so many are toxic
    least_evidence: float = 0.75
    #: a beginning is a stem if so many words go on from it, and no next letter in more than this share of them
    least_branches: int = 3
    most_in_branch: float = 0.7


def learn(
    docs: DataFrame, labels: DataFrame, learning: Learning = Learning(), id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Fit the model: characters from all documents, evidence from the labelled ones.

    ``labels`` has one row per taught document; NULL labels do not teach, and
    of several labels of one id the largest counts. Near copies teach once: of
    documents that share their least shingle hash, one per label is used. To
    the driver come the labels, bounded by ``max_labels``, the character table,
    and counts of the words and beginnings that enough toxic documents have:
    no more than a document has on average, divided by ``least_share``. Clean
    documents are then counted for exactly these.
    """
    sc = docs.sparkSession.sparkContext
    taught = labels.filter(col(label_col).isNotNull() & col(id_col).isNotNull())
    taught = taught.groupBy(col(id_col).cast("bigint").alias("id")).agg(F.max(col(label_col).cast("int")).alias("toxic"))
    total = taught.count()
    if total > learning.max_labels:
        part = int((1 << 20) * learning.max_labels / total)
        taught = taught.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < part)
    rows = taught.orderBy("id").toPandas()
    ids, toxic = rows["id"].to_numpy(np.int64), rows["toxic"].to_numpy(np.int64)
    known = sc.broadcast((ids, toxic))
    source = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).cast("string").alias("text"))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Character pairs of all documents, and the least shingle hash of taught ones."""
        all_ids, all_labels = known.value
        pairs = np.zeros(ALPHABET * ALPHABET, np.int64)
        for batch in slices(batches, 256):
            own = batch.column(0).to_pylist()
            found = texts(batch.column(1))
            pairs += bigram_counts("\n".join(found))
            at = np.searchsorted(all_ids, [i if i is not None else -1 for i in own]) if len(all_ids) else []
            out = []
            for i, k, text in zip(own, at, found):
                if k < len(all_ids) and all_ids[k] == i:
                    ws = words(text)
                    hashed = np.array([xxhash.xxh64_intdigest(w) for w in ws], np.uint64)
                    least = int(mix64(windows(hashed, min(5, len(hashed)))).min() >> np.uint64(1)) if ws else -1
                    out.append((least, i, int(all_labels[k])))
            if out:
                yield pa.record_batch(
                    [pa.array(c, pa.int64()) for c in zip(*out)], names=["least", "id", "n"]
                )
        found_pairs = np.flatnonzero(pairs)
        yield pa.record_batch(
            [
                pa.array(np.full(len(found_pairs), -2), pa.int64()),
                pa.array(found_pairs, pa.int64()), pa.array(pairs[found_pairs], pa.int64()),
            ],
            names=["least", "id", "n"],
        )

    surveyed = source.mapInArrow(survey, "least bigint, id bigint, n bigint")
    is_pair = col("least") == -2
    # one row per character pair, and per least hash and label
    grouped = surveyed.groupBy(
        "least", F.when(is_pair, col("id")).otherwise(col("n")).alias("key")
    ).agg(F.when(F.min(col("least")) == -2, F.sum("n")).otherwise(F.min("id")).alias("value"))
    gathered = grouped.toPandas()
    pairs = gathered[gathered["least"] == -2]
    counts = np.zeros(ALPHABET * ALPHABET)
    counts[pairs["key"].to_numpy(np.int64)] = pairs["value"].to_numpy(np.float64)
    chars = CharModel.from_counts(counts.reshape(ALPHABET, ALPHABET))
    teachers = np.sort(gathered[gathered["least"] != -2]["value"].to_numpy(np.int64))
    n_toxic = int(toxic[np.isin(ids, teachers)].sum())
    prior = (n_toxic + 1) / (len(teachers) + 10)
    least = max(learning.least_documents, int(learning.least_share * n_toxic))
    teaching = toxic[np.searchsorted(ids, teachers)] if len(ids) else toxic
    toxic_of = _document_counts(source, teachers[teaching > 0], chars, None, least)
    clean_of = _document_counts(source, teachers[teaching <= 0], chars, frozenset(toxic_of), 1)
    return ToxicityModel(telling(toxic_of, clean_of, learning), min(0.4, 0.3 * prior), chars)


def telling(toxic_of: dict[str, int], clean_of: dict[str, int], learning: Learning) -> dict[str, float]:
    """The evidence: words and stems most of whose documents are toxic.

    A stem is a beginning from which words go on in several ways, counted among
    such words and beginnings, rather than one word.
    """
    share = {f: n / (n + clean_of.get(f, 0) + 1.0) for f, n in toxic_of.items()}
    share = {f: e for f, e in share.items() if e >= learning.least_evidence}
    branches: dict[str, list[int]] = {}
    for f in share:
        branches.setdefault(f[:-1], []).append(toxic_of[f])

    def is_stem(beginning: str) -> bool:
        longer = branches.get(beginning, []) if len(beginning) < STEMS[-1] else []
        return len(longer) >= learning.least_branches and max(longer) <= learning.most_in_branch * toxic_of[beginning]

    return {f: e for f, e in share.items() if f.endswith(" ") or is_stem(f)}


def _document_counts(
    source: DataFrame, ids: np.ndarray, chars: CharModel, wanted: frozenset[str] | None, least: int
) -> dict[str, int]:
    """How many of the documents ``ids`` have each feature (of ``wanted``, or any), where at least ``least`` have it."""
    spark = source.sparkSession
    shared = spark.sparkContext.broadcast((chars, wanted))
    # no more rows than labels are learnt from
    chosen = F.broadcast(spark.createDataFrame([(i,) for i in ids.tolist()], "id bigint"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_chars, own_wanted = shared.value
        found = Counter()
        for had in document_features(batches, Restorer(own_chars)):
            found.update(had if own_wanted is None else had & own_wanted)
        yield pa.record_batch(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["feature", "n"]
        )

    partial = source.join(chosen, "id").select("text").mapInArrow(count, "feature string, n bigint")
    rows = partial.groupBy("feature").agg(F.sum("n").alias("n")).filter(col("n") >= least).collect()
    return {r["feature"]: r["n"] for r in rows}


def document_features(batches: Iterator[pa.RecordBatch], restorer: Restorer) -> Iterator[set[str]]:
    """The distinct features of each text."""
    kept: dict[str, list[str]] = {}
    for batch in slices(batches, 256):
        for text in texts(batch.column(0)):
            found = [w.decode("utf-8", "surrogatepass") for w in words(text.lower())]
            had: set[str] = set()
            for token in {*join_spaced(found)}:
                fs = kept.get(token)
                if fs is None:
                    if len(kept) >= _KEPT_TOKENS:
                        kept.clear()
                    fs = kept[token] = features(restorer.restore(token))
                had.update(fs)
            yield had


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``score`` from 0 to 1 and ``predicted`` (1 from 0.5 on).

    Scores depend on the text alone. A NULL or empty text has the score of a
    document without evidence. Columns of ``docs`` called like a result column
    are replaced; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(shared.value)

        def compute(columns: Columns) -> Columns:
            scores = [scorer.score(t) for t in texts(columns[0])]
            return [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]

        return compute

    return with_computed(docs, [col(text_col).cast("string")], "score double, predicted int", start)
