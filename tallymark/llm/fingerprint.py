"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs. Each paragraph hashes to a wide
vector, and a document's fingerprint is the sum of its paragraphs' vectors,
lane by lane, modulo a power of two. So the order of paragraphs does not
matter, and a paragraph is inserted or deleted by adding or subtracting its
vector, without the text of the rest.

A vector has three parts: lanes hashed from the whole paragraph, which decide
equality; lanes that count the paragraph's runs of three words with random
signs, whose scalar product estimates how much two documents have in common;
and a count of paragraphs.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm.arrow import with_computed
from tallymark.llm.text import has_word, mix64, slices, texts, windows

#: 32-bit lanes of the exact part and of the likeness part, and words in a run. A lane of the likeness part is a sum of
#: signed counts: it would wrap only past two billion runs.
EXACT_LANES = 64
NEAR_LANES = 128
RUN = 3
_KEPT_HASHES = 500_000
#: Bytes of text in a range of ids that one task sorts.
RANGE_BYTES = 16 << 20

Fingerprint = tuple[np.ndarray, np.ndarray, int]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_HASHES:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


@cache
def _hashes() -> _Hashes:
    return _Hashes()


def paragraphs(text: str) -> list[str]:
    """Lines that hold a word."""
    return [line for line in text.split("\n") if has_word(line)]


def _sum(counted: dict[str, int]) -> Fingerprint:
    exact = np.zeros(EXACT_LANES, np.uint32)
    runs, weights = [], []
    known = _hashes()
    for paragraph, n in counted.items():
        raw = paragraph.encode("utf-8", "surrogatepass")
        exact += np.frombuffer(hashlib.shake_128(raw).digest(4 * EXACT_LANES), "<u4") * np.uint32(n & 0xFFFFFFFF)
        found = raw.split()
        hashed = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        run = windows(hashed, min(RUN, len(hashed)))
        runs.append(run)
        weights.append(np.full(len(run), n, np.int64))
    near = np.zeros(NEAR_LANES, np.uint32)
    if runs:
        mixed = mix64(np.concatenate(runs))
        signs = np.where(mixed >> np.uint64(63), 1, -1) * np.concatenate(weights)
        lanes = (mixed % np.uint64(NEAR_LANES)).astype(np.int64)
        near = np.bincount(lanes, signs, NEAR_LANES).astype(np.int64).astype(np.uint32)
    return exact, near, sum(counted.values())


def fingerprint(text: str) -> Fingerprint:
    """The fingerprint of a text; all zero for a text without words."""
    return _sum(Counter(paragraphs(text)))


def insert(to: Fingerprint, text: str) -> Fingerprint:
    """The fingerprint with the paragraphs of ``text`` added."""
    more = fingerprint(text)
    return to[0] + more[0], to[1] + more[1], to[2] + more[2]


def delete(of: Fingerprint, text: str) -> Fingerprint:
    """The fingerprint with the paragraphs of ``text`` taken out."""
    less = fingerprint(text)
    return of[0] - less[0], of[1] - less[1], of[2] - less[2]


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Estimated share of common word runs, 0 to 1: 1 for equal fingerprints, about 0 for texts without a common run."""
    if a[2] == b[2] and np.array_equal(a[0], b[0]):
        return 1.0
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    size = float(x @ x + y @ y)
    return min(1.0, max(0.0, 2 * float(x @ y) / size)) if size else 0.0


def written(of: Fingerprint) -> str:
    """The fingerprint as text: base64 of its lanes and its count, little-endian."""
    raw = of[0].astype("<u4").tobytes() + of[1].astype("<u4").tobytes() + of[2].to_bytes(8, "little")
    return base64.b64encode(raw).decode()


def read(text: str) -> Fingerprint:
    raw = base64.b64decode(text)
    cut, end = 4 * EXACT_LANES, 4 * (EXACT_LANES + NEAR_LANES)
    return (
        np.frombuffer(raw[:cut], "<u4").copy(), np.frombuffer(raw[cut:end], "<u4").copy(),
        int.from_bytes(raw[end:], "little"),
    )


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``fingerprint``. A NULL text is an empty one; equal texts have equal fingerprints; a
    column of ``docs`` of that name is replaced; an empty table gives an empty result."""

    def start():
        return lambda columns: [pa.array([written(fingerprint(t)) for t in texts(columns[0])], pa.string())]

    return with_computed(docs, [col(text_col).cast("string")], "fingerprint string", start)


# -- a document, its edited text and its neighbour ------------------------------------------

EDITED_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edit_half(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many, or all, of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(doc_id: int | None, text: str, own: Fingerprint, following: str, other: Fingerprint) -> tuple:
    edited = edit_half(text, following)
    changed = fingerprint(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        written(own), written(changed), likeness(own, changed), likeness(own, other),
    )


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, half of which comes from the next document.

    Next is by descending id, NULL last, equal ids by text; after the last
    comes the first, and a table of one row is its own next. The ids are cut
    into ranges of about ``RANGE_BYTES`` of text, each sorted in one task; the first row of a range also goes to
    the range before it. Ids should be whole numbers that identify documents:
    rows of equal id stay in one range. A NULL text is an empty one.
    """
    rows = docs.select(col(id_col).cast("bigint").alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = int(max(4 * spark.sparkContext.defaultParallelism, -(-size // RANGE_BYTES)))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.select("id").agg(F.percentile_approx("id", shares, 100 * ranges)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))[::-1].copy()

    def place(ids: pa.Array) -> np.ndarray:
        """The range of each id: 0 holds the largest ids; NULL has the last range to itself."""
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        found = np.searchsorted(-bounds, -known, side="left")
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds) + 1, found)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(place(batch.column(0)), pa.int64()), batch.column(0)], names=["range", "id"])

    # one row for each range: the id it begins with
    begins = rows.select("id").mapInArrow(placed, "range bigint, id bigint").groupBy("range").agg(F.max("id").alias("id"))
    begins = sorted((r["range"], r["id"]) for r in begins.collect())
    before = {r: begins[i - 1][0] for i, (r, _) in enumerate(begins)}
    first_id = dict(begins)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            at = place(batch.column(0)).tolist()
            ids = batch.column(0).to_pylist()
            twice = [i for i, (r, d) in enumerate(zip(at, ids)) if first_id[r] == d]
            rows = pa.array([*range(batch.num_rows), *twice], pa.int64())
            yield pa.record_batch(
                [
                    pa.array([*at, *(before[at[i]] for i in twice)], pa.int64()),
                    pa.array([0] * batch.num_rows + [1] * len(twice), pa.int8()),
                    batch.column(0).take(rows), batch.column(1).take(rows),
                ],
                names=["range", "extra", "id", "text"],
            )

    dealt = rows.mapInArrow(deal, "range bigint, extra byte, id bigint, text string")
    # ranges are numbered from 0 to len(bounds) + 1, and each is a task
    ordered = dealt.repartitionById(len(bounds) + 2, F.col("range").cast("int")).sortWithinPartitions("range", "extra", F.desc_nulls_last("id"), "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in EDITED_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        held = None  # the row whose next one is awaited: range, id, text, fingerprint
        done: list[tuple] = []
        for batch in slices(batches, 256):
            for at, extra, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                made = None
                if held is not None and held[0] == at:
                    made = fingerprint(text)
                    done.append(_compared(held[1], held[2], held[3], text, made))
                # the first extra row of a range ends it
                held = None if extra else (at, doc_id, text, made if made is not None else fingerprint(text))
            if done:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                done = []

    return ordered.mapInArrow(compare, EDITED_SCHEMA)
