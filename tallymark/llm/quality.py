"""Quality rules by distribution divergence.

A document is compared with its language: Jensen-Shannon distance between the
histograms of its character classes, and of its most common words, and those of
the language. The references are counted from all documents that pass the base
rules and are not full of symbols, in a pass of its own. Short texts have noisy histograms, so each
comparison has a least length below which it does not speak.
"""

from __future__ import annotations

import string
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm.arrow import Columns, with_computed
from tallymark.llm.text import has_word, slices, texts, windows, word_chars, words
from tallymark.sources.scratch import stash

SYMBOLS = "#*$%&|<>"
#: Words in a window that must not occur twice.
WINDOW = 8

CLASSES = ("lower", "upper", "other letter", "digit", "space", "stop", "symbol", "other")
_STOPS = ".,;:'\"-()?"
_TERM_BREAKS = string.punctuation.encode()
_BREAK = bytes.maketrans(_TERM_BREAKS, b" " * len(_TERM_BREAKS))
# Distinct terms that a task holds before it hands its counts on.
_FLUSH_TERMS = 200_000


@dataclass(frozen=True)
class QualityRules:
    """Thresholds. Distances lie between 0 and 1; base rules are the integers."""

    min_words: int = 20
    max_repeat_percent: int = 30
    #: references are counted from documents that pass these and have no more symbols than this among their characters
    max_learn_symbol_percent: int = 1
    #: least code points outside white space for the character classes, and words for the common words, to count
    min_chars: int = 60
    min_terms: int = 60
    #: a histogram of n counts may lie this far off, plus its slack over the root of n
    max_class_distance: float = 0.12
    class_slack: float = 1.8
    max_word_distance: float = 0.12
    word_slack: float = 2.4
    #: a common word makes up at least this share of its language's words: at most 1 / share words
    common_share: float = 0.005
    #: references of languages with at least this share of all words are broadcast, at most 1 / share of them; those of
    #: the other languages stay a table and are joined
    language_share: float = 0.005


@dataclass(frozen=True)
class Reference:
    """Shares of character classes, and of common words with the rest as the last entry."""

    classes: np.ndarray
    words: dict[bytes, int]
    shares: np.ndarray


@dataclass(frozen=True)
class References:
    """Every language's reference: the large languages' by name, the others' as rows (of_lang, total, terms, counts), NULL
    if there are none."""

    by_language: dict[str | None, Reference] = field(default_factory=dict)
    others: DataFrame | None = None


def _reference(terms_: list[bytes], counts: list[int], total: int) -> Reference:
    """From the counts of classes and common words, common words first by count, then by name."""
    classes, common = np.zeros(len(CLASSES)), {}
    for term, n in sorted(zip(terms_, counts), key=lambda t: (-t[1], t[0])):
        if term.startswith(b" "):
            classes[int(term)] = n
        else:
            common[term] = n
    shares = np.array([*common.values(), total - sum(common.values())], np.float64)
    return Reference(classes, dict.fromkeys(common, 0), shares)


@cache
def _class_table() -> np.ndarray:
    table = np.full(0x110000, CLASSES.index("other"), np.uint8)
    kinds = {"Ll": 0, "Lu": 1, "Lt": 1, "Lo": 2, "Lm": 2, "Mn": 2, "Mc": 2, "Nd": 3, "Zs": 4}
    for point in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(point)))
        if kind is not None:
            table[point] = kind
    table[9:14] = CLASSES.index("space")
    for stop in _STOPS:
        table[ord(stop)] = CLASSES.index("stop")
    for symbol in SYMBOLS:
        table[ord(symbol)] = CLASSES.index("symbol")
    return table


def class_counts(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_class_table()[points], minlength=len(CLASSES))


def terms(text: str) -> list[bytes]:
    """Words for the common-word histogram: ASCII lower case, ASCII punctuation breaks them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_BREAK).split()


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance with base 2: 0 for equal, 1 for disjoint histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def half(x: np.ndarray) -> float:
        some = x > 0
        return float((x[some] * np.log2(x[some] / m[some])).sum())

    return max(0.0, (half(p) + half(q)) / 2) ** 0.5


def repeated_words(found: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more; every occurrence counts."""
    n = len(found) - width + 1
    if n < 2:
        return 0
    a = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    a = windows(a, width)
    ordered = np.sort(a)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(a, twice))
    edge = np.zeros(len(found) + 1, np.int64)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    found = words(text)
    lines = [line for line in text.split("\n") if has_word(line)]
    return (
        len(found), word_chars(text), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(found),
    )


def base_fails(n_words: int, n_repeat: int, rules: QualityRules) -> bool:
    return n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n_words


def distances(text: str, own: Reference | None, rules: QualityRules) -> tuple[float, float, bool]:
    """Class and word distance to the language's reference, and whether both are within bounds; 0 where the text is too
    short or there is no reference."""
    if own is None:
        return 0.0, 0.0, True
    by_class = by_word = 0.0
    fits = True
    counts = class_counts(text)
    chars = int(counts.sum() - counts[CLASSES.index("space")])
    if chars >= rules.min_chars:
        by_class = jensen_shannon(counts, own.classes)
        fits = by_class <= rules.max_class_distance + rules.class_slack / chars**0.5
    found = terms(text)
    # without common words there is no histogram to compare with
    if len(found) >= rules.min_terms and own.words:
        tally = Counter(found)
        have = np.fromiter((tally.get(w, 0) for w in own.words), np.float64, len(own.words))
        by_word = jensen_shannon(np.append(have, len(found) - have.sum()), own.shares)
        fits = fits and by_word <= rules.max_word_distance + rules.word_slack / len(found) ** 0.5
    return by_class, by_word, fits


def count_language_terms(docs: DataFrame, rules: QualityRules, text_col: str, lang_col: str) -> DataFrame:
    """Rows (lang, term, n) over all documents fit to learn from; a class's term is a space and its number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str | None, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for language, tally in tallies.items():
                yield pa.record_batch(
                    [
                        pa.array([language] * len(tally), pa.string()),
                        pa.array(list(tally), pa.binary()),
                        pa.array(list(tally.values()), pa.int64()),
                    ],
                    names=["lang", "term", "n"],
                )
            tallies.clear()

        for batch in slices(batches):
            for text, language in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                found = words(text)
                symbols = 100 * sum(map(text.count, SYMBOLS))
                if symbols > rules.max_learn_symbol_percent * len(text) or base_fails(
                    len(found), repeated_words(found), rules
                ):
                    continue
                tally = tallies.setdefault(language, Counter())
                tally.update(terms(text))
                for i, n in enumerate(class_counts(text).tolist()):
                    if n:
                        tally[b" %d" % i] += n
            if sum(map(len, tallies.values())) > _FLUSH_TERMS:
                yield from flush()
        yield from flush()

    narrow = docs.select(col(text_col).cast("string"), col(lang_col).cast("string"))
    partial = narrow.mapInArrow(count, "lang string, term binary, n bigint")
    return partial.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def learn_references(
    docs: DataFrame, rules: QualityRules = QualityRules(), text_col: str = "text", lang_col: str = "lang"
) -> References:
    """Count the references of all languages. To the driver come at most 1 / language_share of them, with at most
    1 / common_share words each."""
    counted = stash(count_language_terms(docs, rules, text_col, lang_col), "language-terms")
    is_class = F.substring("term", 1, 1) == F.lit(b" ")
    # a language whose learned texts have no terms still has its classes
    sums = counted.groupBy(col("lang").alias("of_lang")).agg(F.sum(F.when(is_class, 0).otherwise(col("n"))).alias("total"))
    shared = counted.join(sums, col("lang").eqNullSafe(col("of_lang"))).filter(
        is_class | (col("n") >= rules.common_share * col("total"))
    )
    gathered = shared.groupBy("of_lang", "total").agg(F.collect_list(F.struct("term", "n")).alias("found"))
    table = stash(
        gathered.select("of_lang", "total", F.col("found.term").alias("terms"), F.col("found.n").alias("counts")), "language-references"
    )
    everything = table.agg(F.sum("total")).first()[0] or 0
    is_large = col("total") >= max(1, rules.language_share * everything)
    large = {
        r["of_lang"]: _reference([bytes(t) for t in r["terms"]], r["counts"], r["total"]) for r in table.filter(is_large).collect()
    }
    others = table.filter(~is_large)
    return References(large, None if others.isEmpty() else others)


SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, class_distance double, word_distance double, kept boolean"
)


def judge(
    docs: DataFrame,
    references: References,
    rules: QualityRules = QualityRules(),
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """All rows of ``docs`` with base counts, distances and the verdict ``kept``.

    A NULL or empty text has no words and fails. NULL is a language like the
    others; for a language without a reference (no text fit to learn from) only
    the base rules speak. Repeated rows are judged alike. Columns of ``docs``
    called like a result column are replaced; an empty table gives an empty result.
    """
    by_language = docs.sparkSession.sparkContext.broadcast(references.by_language)
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]

    def start():
        joined: dict[str | None, Reference] = {}

        def reference(language: str | None, columns: Columns, i: int) -> Reference | None:
            own = by_language.value.get(language)
            if own is None and columns and columns[0][i].is_valid:
                if language not in joined:
                    joined.clear()  # rows come by language
                    total, found, counts = (c[i].as_py() for c in columns)
                    joined[language] = _reference(found, counts, total)
                own = joined[language]
            return own

        def compute(columns: Columns) -> Columns:
            rows = []
            for i, (text, language) in enumerate(zip(texts(columns[0]), columns[1].to_pylist())):
                counts = base_counts(text)
                failed = base_fails(counts[0], counts[4], rules)
                by_class, by_word, fits = distances(text, reference(language, columns[2:], i), rules)
                rows.append((*counts, failed, by_class, by_word, not failed and fits))
            return [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]

        return compute

    text, language = col(text_col).cast("string"), col(lang_col).cast("string")
    if references.others is None:
        return with_computed(docs, [text, language], SCHEMA, start)
    named = [x for x in references.by_language if x is not None]
    is_large = F.coalesce(language.isin(named), F.lit(None in references.by_language))
    large = with_computed(docs.filter(is_large), [text, language], SCHEMA, start)
    others = references.others.toDF("_of_lang", "_total", "_terms", "_counts")
    small = docs.filter(~is_large).join(others, language.eqNullSafe(col("_of_lang")), "left")
    inputs = [text, language, col("_total"), col("_terms"), col("_counts")]
    judged = with_computed(small, inputs, SCHEMA, start).drop("_of_lang", "_total", "_terms", "_counts")
    return large.unionByName(judged)
