"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to a logarithmic scale, and an
n-gram of level q is put into a Bloom filter q times, once for each level up to
its own. A reader probes levels upwards until one is missing; the last that was
there gives the count. So a few bits hold an n-gram with its frequency. The bits
grow with the n-grams of the corpus, and no level stays out.

The filter is a table of slices by the n-gram's hash. One task adds up the counts
of a slice and sets its bits; counts travel as packed arrays, added up in each
task before. To be scored, texts are put together to chunks; the distinct n-grams
of a chunk go to their slices by a shuffle, and the levels found there come back
to the chunk by another.

The base score needs every word's exact count. Words that make up at least
1 / 2**20 of the training tokens are broadcast (there are at most 2**20), the
others are joined. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm.text import mix64, slices, texts, words
from tallymark.sources.scratch import stash

_END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xD1342543DE82EF95)
_LEVEL = np.uint64(0xAF251AF3B0F025B5)
_KEPT_HASHES = 500_000
_FLUSH_TOKENS = 2_000_000
#: Low bits of a packed n-gram that hold its count; the slice number and the other bits tell n-grams apart. In a slice
#: of 8 million n-grams, one in 130,000 meets another with the same bits, far less than the filter's own errors.
_COUNT_BITS = 24
#: Training tokens whose n-grams one slice of the filter holds.
SLICE_TOKENS = 4_000_000


@dataclass(frozen=True)
class LmSettings:
    #: counts are told apart by powers of this
    step: float = 1.5
    #: n-grams seen less often stay out
    least_count: int = 2
    #: bits for each insertion, and probes for each
    bits_each: int = 10
    probes: int = 4
    #: weight of the pair model beside the word model
    pair_weight: float = 0.25
    #: words with this share of the training tokens are broadcast with their exact counts
    head_share: float = 2.0**-20


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_HASHES:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


@cache
def _hashes() -> _Hashes:
    return _Hashes()


def token_hashes(text: str) -> np.ndarray:
    """Hashes of the words, A-Z in lower case, and of the end."""
    found = words(text, lower=True)
    out = np.empty(len(found) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_hashes().__getitem__, found), np.uint64, len(found))
    out[-1] = _END
    return out


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before it."""
    return mix64(np.concatenate([[_START], tokens[:-1]]) * _PAIR + tokens)


def word_grams(tokens: np.ndarray) -> np.ndarray:
    return mix64(tokens ^ _WORD)


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers for the shuffle: byte by byte, the high bytes of all together, compressed."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    planes = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _steps(ordered: np.ndarray) -> np.ndarray:
    """The first of ascending numbers, then how much each adds to the one before."""
    return np.diff(ordered, prepend=np.uint64(0))


# -- the filter -----------------------------------------------------------------------------


@dataclass(frozen=True)
class FrequencyFilter:
    """Slices of bits, and how counts are read from them."""

    bits: np.ndarray  # bytes of all slices, one after another
    starts: np.ndarray  # first bit of each slice
    sizes: np.ndarray  # bits of each slice
    shift: int  # a hash's slice is what this leaves of it
    lowest: int  # levels below are not held
    settings: LmSettings

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Estimated counts: 0 where the lowest level is missing, else the middle of the last level found."""
        level = self.levels(hashes)
        return np.where(level > 0, level_count(level, self.settings.step), 0.0)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The last level found, 0 where the lowest is missing."""
        level = np.zeros(len(hashes), np.int64)
        if not len(self.bits) or not len(hashes):
            return level
        part = (hashes >> np.uint64(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.sizes[part] > 0)
        j = self.lowest
        while len(at):
            first, step = _positions(hashes[at], j)
            for i in range(self.settings.probes):
                bit = (first + np.uint64(i) * step) % self.sizes[part[at]].astype(np.uint64)
                bit = bit.astype(np.int64) + self.starts[part[at]]
                there = (self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
                at, first, step = at[there], first[there], step[there]
            level[at] = j
            j += 1
        return level


def _positions(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes of an n-gram's level start, and how far they lie apart."""
    mixed = mix64(hashes + np.uint64(level) * _LEVEL)
    return mixed >> np.uint64(32), (mixed & np.uint64(0xFFFFFFFF)) | np.uint64(1)


def count_level(counts: np.ndarray, step: float) -> np.ndarray:
    """1 for a count of 1, one more for each power of ``step``."""
    return 1 + np.floor(np.log(counts) / np.log(step) + 1e-9).astype(np.int64)


def level_count(level: np.ndarray, step: float) -> np.ndarray:
    """The middle of the whole counts of a level."""
    low = np.ceil(step ** (level - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(step**level - 1e-9) - 1)
    return (low + high) / 2


def set_bits(hashes: np.ndarray, levels: np.ndarray, lowest: int, settings: LmSettings) -> bytes:
    """A slice that holds each n-gram at its levels from ``lowest`` on."""
    kept = levels >= lowest
    hashes, levels = hashes[kept], levels[kept]
    size = -(-int((levels - lowest + 1).sum()) * settings.bits_each // 64) * 64
    flags = np.zeros(size, bool)
    for level in range(lowest, int(levels.max(initial=0)) + 1):
        first, step = _positions(hashes[levels >= level], level)
        for i in range(settings.probes):
            flags[((first + np.uint64(i) * step) % np.uint64(size)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


# -- counting -----------------------------------------------------------------------------------


def count_words(training: DataFrame) -> DataFrame:
    """Rows (word, n): hash and exact count of each token of the training texts (column text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            found, n = np.unique(np.concatenate(chunk), return_counts=True)
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return training.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Token hashes of texts, in lists of bounded size."""
    chunk, size = [], 0
    for batch in slices(batches, 256):
        for text in texts(batch.column(0)):
            tokens = token_hashes(text)
            chunk.append(tokens)
            size += len(tokens)
            if size >= _FLUSH_TOKENS:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def slice_digits(tokens: int) -> int:
    """Leading bits of a hash that number its slice."""
    return max(0, (max(1, tokens) // SLICE_TOKENS).bit_length())


def build_filter(training: DataFrame, tokens: int, settings: LmSettings = LmSettings()) -> DataFrame:
    """Rows (part, bits): words and pairs of the training texts, counted and put into the slices of a filter."""
    digits = slice_digits(tokens)
    shift = 64 - digits
    low = np.uint64(_COUNT_BITS)
    most = (1 << _COUNT_BITS) - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            grams = [g for t in chunk for g in (pair_hashes(t), word_grams(t))]
            found, n = np.unique(np.concatenate(grams), return_counts=True)
            # slice number, then 48 bits of hash and 16 of count; larger counts take several entries
            part = (found >> np.uint64(shift)).astype(np.int64) if digits else np.zeros(len(found), np.int64)
            entries = -(-n // most)
            packed = np.repeat((found << np.uint64(digits)) >> low << low, entries)
            share = np.full(len(packed), most, np.uint64)
            last = np.cumsum(entries) - 1
            share[last] = (n - (entries - 1) * most).astype(np.uint64)
            packed |= share
            part = np.repeat(part, entries)
            edges = np.flatnonzero(np.diff(part)) + 1
            numbers = part[np.concatenate([[0], edges])] if len(part) else []
            yield pa.record_batch(
                [pa.array(numbers, pa.int64()), pa.array([_pack(_steps(p)) for p in np.split(packed, edges)], pa.binary())],
                names=["part", "packed"],
            )

    def add(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.concatenate([np.cumsum(_unpack(p, np.uint64)) for b in tables for p in b.column("packed").to_pylist()])
        packed = np.sort(packed)
        hashes = packed >> low
        firsts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        n = np.add.reduceat((packed & np.uint64(most)).astype(np.int64), firsts)
        kept = n >= settings.least_count
        part = np.uint64(key[0].as_py())
        # the whole hash again, but for the bits that the packing left out
        whole = (hashes[firsts][kept] << low) >> np.uint64(digits)
        if digits:
            whole |= part << np.uint64(shift)
        bits = set_bits(whole, count_level(n[kept], settings.step), 1, settings)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()), pa.array([bits], pa.binary())], names=["part", "bits"])

    packed = training.mapInArrow(count, "part bigint, packed binary")
    return stash(packed.groupBy("part").applyInArrow(add, "part bigint, bits binary"), "lm-filter")


def cut_hash(hashes: np.ndarray, digits: int) -> np.ndarray:
    """The bits of an n-gram's hash that survive the packing."""
    gone = np.uint64(max(0, _COUNT_BITS - digits))
    return hashes >> gone << gone


# -- scoring ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LanguageModel:
    """The filter's slices, the counts of frequent words (sorted hashes), the other words' table, and the totals."""

    slices: DataFrame
    head: np.ndarray
    head_counts: np.ndarray
    tail: DataFrame
    tokens: int
    types: int
    settings: LmSettings


def train(training: DataFrame, settings: LmSettings = LmSettings()) -> LanguageModel:
    """Fit the model to the texts of ``training`` (one column)."""
    source = training.select(col(training.columns[0]).cast("string").alias("text"))
    counts = stash(count_words(source), "lm-words")
    totals = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    tokens, types = totals["tokens"] or 0, totals["types"]
    bound = max(1, int(np.ceil(settings.head_share * tokens)))
    head = counts.filter(col("n") >= bound).orderBy("word").toPandas()
    hashes = head["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return LanguageModel(
        build_filter(source, tokens, settings), hashes[order], head["n"].to_numpy(np.int64)[order],
        counts.filter(col("n") < bound), tokens, types, settings,
    )


@dataclass(frozen=True)
class _Grams:
    """Distinct words and pairs of some texts: their hashes as the filter holds them, and where each token's are."""

    hashes: np.ndarray  # sorted, so that those of a slice lie together
    single: np.ndarray  # of each token's word
    both: np.ndarray  # of each token after the one before it
    end: int  # of the end of a text

    @classmethod
    def of(cls, distinct: np.ndarray, inverse: np.ndarray, lengths: np.ndarray, digits: int) -> _Grams:
        flat = distinct[inverse]
        before = np.concatenate([[_START], flat[:-1]])
        before[np.cumsum(lengths)[:-1]] = _START
        pairs = mix64(before * _PAIR + flat)
        grams = cut_hash(np.concatenate([pairs, word_grams(distinct), word_grams(np.array([_END]))]), digits)
        hashes, at = np.unique(grams, return_inverse=True)
        n = len(flat)
        return cls(hashes, at[n:-1][inverse], at[:n], int(at[-1]))


_SCORED = "row bigint, word bigint, id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
#: What goes to the slices and comes back: bits of the filter (kind 0), hashes or levels (1), a chunk of texts (2).
_ROUTED = (
    "part bigint, kind int, chunk bigint, packed binary, distinct binary, lengths array<bigint>, ids array<bigint>,"
    " held array<boolean>"
)
_ROUTED_KINDS = pa.schema(
    [
        ("part", pa.int64()), ("kind", pa.int32()), ("chunk", pa.int64()), ("packed", pa.binary()), ("distinct", pa.binary()),
        ("lengths", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    ]
)


def _routed(rows: list[tuple]) -> pa.RecordBatch:
    filled = [(*r, *[None] * (len(_ROUTED_KINDS) - len(r))) for r in rows]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*filled), _ROUTED_KINDS)], schema=_ROUTED_KINDS)


def _ask(docs: DataFrame, digits: int) -> DataFrame:
    """Chunks of texts, and the hashes that each asks of each slice."""
    parts = 1 << digits
    gone = np.uint64(max(0, _COUNT_BITS - digits))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 40
        tokens, ids, held, size = [], [], [], 0

        def full() -> Iterator[pa.RecordBatch]:
            distinct, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
            lengths = np.array([len(t) for t in tokens])
            hashes = _Grams.of(distinct, inverse, lengths, digits).hashes
            own = int(mix64(np.array([chunk], np.uint64))[0]) % parts
            yield _routed(
                [(own, 2, chunk, _pack(inverse.astype(np.uint32)), _pack(_steps(distinct)), lengths.tolist(), ids, held)]
            )
            numbers = (hashes >> np.uint64(64 - digits)).astype(np.int64) if digits else np.zeros(len(hashes), np.int64)
            edges = np.flatnonzero(np.diff(numbers)) + 1
            asked = zip(numbers[np.concatenate([[0], edges])].tolist(), np.split(hashes, edges))
            yield _routed([(part, 1, chunk, _pack(_steps(h >> gone))) for part, h in asked])

        for batch in slices(batches, 256):
            for i, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))):
                tokens.append(token_hashes(text))
                ids.append(i)
                held.append(out)
                size += len(tokens[-1])
                if size >= _FLUSH_TOKENS:
                    yield from full()
                    chunk += len(tokens)
                    tokens, ids, held, size = [], [], [], 0
        if tokens:
            yield from full()

    return docs.mapInArrow(ask, _ROUTED)


def _answer(asked: DataFrame, filter_slices: DataFrame, digits: int, settings: LmSettings) -> DataFrame:
    """The same rows, with levels in place of hashes. Each slice meets what is asked of it; nothing is broadcast."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (c.rsplit(" ", 1) for c in _ROUTED.split(", ")[4:])]
    held = filter_slices.select(
        "part", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("chunk"), col("bits").alias("packed"), *nothing
    )

    gone = np.uint64(max(0, _COUNT_BITS - digits))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, table = None, None
        for batch in slices(batches, 64):
            out = []
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    bits = np.frombuffer(r["packed"], np.uint8)
                    part, table = r["part"], FrequencyFilter(bits, np.array([0]), np.array([8 * len(bits)]), 64, 1, settings)
                elif r["kind"] == 2:
                    out.append(tuple(r.values()))
                else:
                    hashes = np.cumsum(_unpack(r["packed"], np.uint64)) << gone
                    # a slice that holds nothing has no row
                    levels = table.levels(hashes) if part == r["part"] else np.zeros(len(hashes), np.int64)
                    out.append((r["part"], 1, r["chunk"], _pack(levels.astype(np.uint8))))
            if out:
                yield _routed(out)

    return held.unionByName(asked).repartition("part").sortWithinPartitions("part", "kind").mapInArrow(answer, _ROUTED)


def score(
    docs: DataFrame, held_out: Column, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for all rows of ``docs``.

    ``score`` is the log10 probability of the text under the smoothed pair
    model, ``base_score`` that under add-one word frequencies with exact counts.
    A NULL or empty text is one end token. Repeated rows and NULL ids are rows
    of their own; an empty table gives an empty result, and a model trained on
    nothing knows no word.
    """
    sc = docs.sparkSession.sparkContext
    digits, settings, total = slice_digits(model.tokens), model.settings, model.tokens + model.types + 1.0
    shared = sc.broadcast((model.head, np.log10(model.head_counts + 1.0)))
    source = docs.select(
        col(id_col).cast("bigint").alias("id"), held_out.cast("boolean").alias("held_out"), col(text_col).cast("string").alias("text")
    )
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = [c.split(" ")[0] for c in _SCORED.split(", ")]

    def finish(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, texts_ = [], None
        for batch in tables:
            for r in batch.to_pylist():
                if r["kind"] == 2:
                    texts_ = r
                else:
                    answers.append((r["part"], r["packed"]))
        levels = np.concatenate([_unpack(packed, np.uint8) for _, packed in sorted(answers)]).astype(np.int64)
        n = np.array(texts_["lengths"])
        distinct, inverse = np.cumsum(_unpack(texts_["distinct"], np.uint64)), _unpack(texts_["packed"], np.uint32)
        owner = np.repeat(np.arange(len(n)), n)
        base, known, tail = _exact(distinct, inverse, owner, len(n), shared.value)
        logs = _log_probabilities(_Grams.of(distinct, inverse, n, digits), levels, n, total, settings)
        rows = key[0].as_py() + np.arange(len(n))
        # a document's own row gets a key that spreads, a row for each rare word its hash
        yield pa.record_batch(
            [pa.array(rows), pa.array(mix64(rows.astype(np.uint64)).view(np.int64)), pa.array(texts_["ids"], pa.int64()),
             pa.array(texts_["held"], pa.bool_()), pa.array(n), pa.array(known), pa.array(base),
             pa.array(np.bincount(owner, logs, len(n)))],
            schema=pa.schema(list(zip(names, kinds))),
        )
        none = [pa.nulls(len(tail), k) for k in kinds[2:]]
        yield pa.record_batch(
            [pa.array(rows[owner[tail]]), pa.array(distinct[inverse[tail]].view(np.int64)), *none],
            schema=pa.schema(list(zip(names, kinds))),
        )

    scored = _answer(_ask(source, digits), model.slices, digits, settings).groupBy("chunk").applyInArrow(finish, _SCORED)
    tail = model.tail.select(col("word").alias("known_word"), "n")
    joined = scored.join(tail, col("word") == col("known_word"), "left")
    own = col("n_tokens").isNotNull()
    rare = F.when(~own & col("n").isNotNull(), F.log10(col("n") + 1))
    summed = joined.groupBy("row").agg(
        F.max("id").alias("id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.max("n_known").alias("head_known"), F.count(rare).alias("tail_known"),
        F.max("base").alias("head_base"), F.sum(rare).alias("tail_base"), F.max("score").alias("score"),
    )
    rest = float(np.log10(model.tokens + model.types + 1.0))
    return summed.select(
        col("id").alias("doc_id"), F.coalesce("held_out", F.lit(False)).alias("held_out"), "n_tokens",
        (col("head_known") + col("tail_known")).alias("n_known"),
        F.lit(int(model.tokens)).cast("bigint").alias("train_tokens"),
        (col("head_base") + F.coalesce("tail_base", F.lit(0.0)) - col("n_tokens") * F.lit(rest)).alias("base_score"),
        "score",
    )


def _exact(
    distinct: np.ndarray, inverse: np.ndarray, owner: np.ndarray, n: int, model: tuple
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document the sum of log10(count + 1) and the number of frequent words; and which tokens are not frequent."""
    head, logs = model
    if not len(head):
        return np.zeros(n), np.zeros(n, np.int64), np.arange(len(inverse))
    at = np.minimum(np.searchsorted(head, distinct), len(head) - 1)
    there = head[at] == distinct
    frequent = there[inverse]
    base = np.bincount(owner, np.where(there, logs[at], 0.0)[inverse], n)
    return base, np.bincount(owner[frequent], minlength=n).astype(np.int64), np.flatnonzero(~frequent)


def _log_probabilities(grams: _Grams, levels: np.ndarray, lengths: np.ndarray, total: float, settings: LmSettings) -> np.ndarray:
    """log10 of each token's probability after the token before it."""
    weight = settings.pair_weight
    counts = np.where(levels > 0, level_count(levels, settings.step), 0.0)
    single, both = counts[grams.single], counts[grams.both]
    p = (single + 1.0) / total
    before = np.concatenate([[0.0], single[:-1]])
    before[np.cumsum([0, *lengths[:-1]])] = counts[grams.end]  # as many starts as ends
    after = np.minimum(both / np.maximum(before, np.maximum(both, 1.0)), 1.0)
    # a pair model knows nothing after a token that was never seen
    return np.log10(np.where(before > 0, weight * after + (1 - weight) * p, p))
