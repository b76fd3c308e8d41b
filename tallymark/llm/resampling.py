"""Importance resampling of documents towards a target's distribution of words and word pairs.

Hashed features are counted over all documents and over the target; the log
ratio of both gives every bucket a gain. Gains lie in one array, so a document's
weight is the mean of array look-ups. Gumbel noise from the id turns the draw
into a choice of the highest scores, whose k-th key is found by a distributed
quickselect: random pivots, exact counts of what is below, at and above each,
and on with what lies between two of them. Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm.arrow import with_computed
from tallymark.llm.text import slices, texts
from tallymark.operators.rownumber import number_rows
from tallymark.sources.scratch import stash

BUCKETS = 10_000
#: Pivots of a round of the quickselect.
PIVOTS = 16

# A-Z become lower case; other ASCII than letters and digits becomes a space
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def fold_words(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and everything beyond ASCII, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class _Features:
    """Buckets of words and pairs; checksums of words met in this task are kept for a while."""

    def __init__(self, most: int = 1 << 17):
        self.known: dict[bytes, tuple[int, bytes]] = {}
        self.most = most

    def buckets(self, text: str) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of each feature."""
        known = self.known
        if len(known) > self.most:
            known.clear()
        found = []
        for word in fold_words(text):
            pair = known.get(word)
            if pair is None:
                pair = known[word] = (zlib.crc32(word), b" " + word)
            found.append(pair)
        crc32 = zlib.crc32
        sums = [c for c, _ in found]
        # the checksum of "a b" goes on from that of "a"
        sums += [crc32(after[1], before[0]) for before, after in zip(found, found[1:])]
        return len(found), (np.array(sums, np.uint32) % BUCKETS).astype(np.int64)


def count_features(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features of all texts by bucket: an array of ``BUCKETS`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, totals = _Features(), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, 256):
            for text in texts(batch.column(0)):
                totals += np.bincount(features.buckets(text)[1], minlength=BUCKETS)
        some = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(some), pa.array(totals[some])], names=["bucket", "n"])

    counted = docs.select(col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source share of each bucket, with one added to each count."""
    s_all, t_all = int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (s_all + BUCKETS)) / float((s + 1) * (t_all + BUCKETS))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``, the floored mean gain of its features (none: 0)."""

    def start():
        features = _Features()

        def compute(columns):
            out = []
            for text in texts(columns[0]):
                n_words, buckets = features.buckets(text)
                n = len(buckets)
                out.append((n_words, n, int(gain[buckets].sum()) // n if n else 0))
            return [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3

        return compute

    return with_computed(docs, [col(text_col).cast("string")], "n_words bigint, n_features bigint, weight bigint", start)


def gumbel(id_col: str, seed: str) -> Column:
    """Thousandths of a Gumbel number that depends on the id alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(seed), F.coalesce(col(id_col).cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


# -- the k-th key -------------------------------------------------------------------------------


def kth_key(rows: DataFrame, names: list[str], k: int) -> tuple:
    """The k-th of the keys ``names`` (none NULL, at least ``k`` rows) in ascending order, by quickselect.

    A round reads the rows that are still in question, draws pivots from them at
    random, and counts the rows below and at each pivot. What lies between the
    two pivots around the k-th row is written out and goes on.
    """
    turn = 0
    while True:
        key = F.struct(*names)
        by_chance = F.xxhash64(*names, F.lit(turn))
        drawn = rows.select(*names).distinct().orderBy(by_chance, *names).limit(PIVOTS).collect()
        pivots = sorted(tuple(r) for r in drawn)
        fixed = [F.struct(*[F.lit(v).cast(rows.schema[n].dataType).alias(n) for v, n in zip(p, names)]) for p in pivots]
        counts = rows.agg(
            *[F.count_if(key < p).alias(f"below{i}") for i, p in enumerate(fixed)],
            *[F.count_if(key == p).alias(f"at{i}") for i, p in enumerate(fixed)],
        ).first()
        low, high, passed = None, None, 0
        for i, pivot in enumerate(pivots):
            below, upto = counts[f"below{i}"], counts[f"below{i}"] + counts[f"at{i}"]
            if below < k <= upto:
                return pivot
            if upto < k:
                low, passed = fixed[i], upto
            elif high is None:
                high = fixed[i]
        between = F.lit(True)
        if low is not None:
            between = between & (key > low)
        if high is not None:
            between = between & (key < high)
        rows, k, turn = stash(rows.filter(between), "select-rest"), k - passed, turn + 1


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    percent: int = 25,
    least_words: int = 20,
    seed: str = "7:",
) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the documents with at least ``least_words`` words, ``percent`` percent
    (rounded down) with the highest scores are drawn and ranked 1, 2, 3, …; equal
    scores go to the smaller id, a NULL id comes last, and rows of equal id and
    score are told apart at will. All others have no rank. A NULL text has no
    words; a NULL id draws its noise as an empty text does. Ids are whole
    numbers. Columns of ``docs`` named like a result column are replaced; an empty
    table gives an empty result, an empty target counts as one without features.
    To the driver come one count a bucket, and the pivots.
    """
    gain = gains(count_features(docs, text_col), count_features(target, target_text))
    spare = [c for c in docs.columns if c not in ("n_words", "n_features", "weight", "score", "rank")]
    weighed = weigh(docs, gain, text_col)
    own = {
        "_rs_score": -(col("weight") + gumbel(id_col, seed)),
        "_rs_none": col(id_col).isNull().cast("int"),
        "_rs_id": F.coalesce(col(id_col).cast("bigint"), F.lit(0).cast("bigint")),
    }
    # the text is left behind here and joined by nobody: it is read twice, and never moved
    scored = stash(weighed.withColumns(own), "resample-scored")
    key = list(own)
    fit = col("n_words") >= least_words
    k = scored.filter(fit).count() * percent // 100
    score = (-col("_rs_score")).alias("score")
    results = [*[col(c) for c in spare], col("n_words"), col("n_features"), col("weight"), score]
    if k == 0:
        return scored.select(*results, F.lit(None).cast("bigint").alias("rank"))
    last = kth_key(scored.filter(fit).select(*key), key, k)
    cut = F.struct(*[F.lit(v).cast(scored.schema[n].dataType).alias(n) for v, n in zip(last, key)])
    wins = fit & (F.struct(*key) <= cut)
    ranked = number_rows(scored.filter(wins), key, name="_rs_rank")
    rank = F.when(col("_rs_rank") <= k, col("_rs_rank")).cast("bigint").alias("rank")
    return ranked.select(*results, rank).unionByName(
        scored.filter(~wins).select(*results, F.lit(None).cast("bigint").alias("rank"))
    )
