"""Passages that an earlier document already holds, found by a depth-limited radix sort of suffixes.

Suffixes are told apart only through their first ``length`` bytes (their
*window*), most significant digit first, and a suffix leaves the sort as soon as
its digits so far occur in one document only:

1. The first digit is the window's least gram (by a hash; 20 of 50 bytes).
   Neighbouring suffixes mostly share it, so a *stretch* of some 16 of them
   travels as one key. Nearly all stretches of a corpus end here.
2. The second digit is the stretch as a whole. Where all stretches of one first
   digit are equal, all their suffixes are equal at once. Stretches that an
   earlier document holds are removed; the first holder of each stays.
3. Where stretches of one first digit differ, their first holders meet, and
   their suffixes are sorted one by one through all of their bytes, eight at a
   time. Groups that are equal through the threshold are the repeated windows.
   A first digit with very many stretches does not meet in one place: each of
   its suffixes goes by a hash of its whole window and is sorted there.

Documents lie in chunks of a bucketed table, so that a pass reads them in place:
only digits move. A chunk sends each digit once, however many of its documents
hold it, with the least id of these; a digit that all documents hold is one entry
a chunk. The slice that a digit belongs to answers with one bit an entry.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tallymark.functions.names import col
from tallymark.llm.text import mix64
from tallymark.sources.scratch import scratch_path, stash

#: Bytes of text in a chunk, least and most; between them a chunk is a 2000th of all.
CHUNK_BYTES = (4 << 20, 64 << 20)
#: Bytes of text whose digits meet in one slice.
SLICE_BYTES = 8 << 20
#: Bytes of text in a bucket of the table.
BUCKET_BYTES = 32 << 20
#: Bytes that are hashed at a time, and suffixes that are sorted at a time.
BLOCK_BYTES = 1 << 18
SORT_ROWS = 1 << 19
#: A first digit with more stretches than this is dealt out by suffix.
HOT_STRETCHES = 4096

RESULT_SCHEMA = "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
_ENTRY_SCHEMA = "chunk bigint, kind int, slice bigint, data binary"

# the kinds of entries that chunks send; a state is sent to oneself
_DIGIT, _ALIKE, _STRETCH, _OPEN, _WINDOW, _STATE = 1, 2, 3, 4, 5, 6


def _odd(count: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


_BYTE = _odd(256, 1)
_LEVEL = _odd(64, 2)
_STEP = _odd(2, 3)


# -- digits of suffixes ------------------------------------------------------------------


def _gram_hashes(block: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes at every position, put together from powers of two."""
    power, span, level = _BYTE[block], 1, 0
    out, done = None, 0
    while True:
        if width & span:
            if out is None:
                out = power
            else:
                n = len(power) - done
                out = out[:n] * _LEVEL[32 + level] + power[done:]
            done += span
        if span * 2 > width:
            return mix64(out)
        power = power[:-span] * _LEVEL[level] + power[span:]
        span, level = span * 2, level + 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _words(text: np.ndarray, at: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """The windows at some positions as 64-bit words, most significant byte first; the last may overlap the one before."""
    words = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    for offset in [*range(0, length - 8, 8), length - 8]:
        yield words[at + offset].astype(np.uint64)


def _window_hashes(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for i, word in enumerate(_words(text, at, length)):
        out = mix64(out + (word ^ _LEVEL[16 + i % 16]) * _LEVEL[i % 16])
    return out


def gram_width(length: int) -> int:
    """Bytes of the first digit of windows of ``length`` bytes."""
    return 2 * length // 5


def equal_windows(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Number the windows at some positions by equality, with a most-significant-digit radix sort.

    Windows are ordered by their first eight bytes; those that share them with
    no other are done; the others go on to the next five bytes within their
    group, until ``length`` bytes are compared. Returns for every window the
    number of its group.
    """
    words = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    group = np.zeros(len(at), np.int64)
    active, groups = np.arange(len(at)), 0
    first = np.zeros(len(at), np.uint64)  # group and digit in one number; groups stay below 2 ** 24
    for offset in [0, *range(8, length, 5)]:
        # the five bytes from ``offset`` on are the last of the eight that begin before; the last digit may look back
        digit = words[at[active] + (0 if offset == 0 else min(offset + 5, length) - 8)].astype(np.uint64)
        if offset:
            digit = (digit & np.uint64((1 << 40) - 1)) | first[: len(active)]
        order = np.argsort(digit)
        active, digit = active[order], digit[order]
        new = np.ones(len(active), bool)
        new[1:] = digit[1:] != digit[:-1]
        number = np.cumsum(new) - 1
        group[active] = groups + number
        groups += int(new.sum())
        several = np.bincount(number)[number] > 1 if len(number) else new
        active = active[several]
        first = np.cumsum(new[several]).astype(np.uint64) << np.uint64(40)
    return group


class _Groups:
    """Equal keys: the ``first`` of each in sorted order, the group of each entry, and the range of their ids.

    Entries are sorted by the first key alone, a hash of them all, and compared by all: keys that share the hash by
    chance may end up in more groups than they have values, never in fewer.
    """

    def __init__(self, keys: list[np.ndarray], ids: np.ndarray):
        order = np.argsort(keys[0])
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = reduce(np.logical_or, (k[order][1:] != k[order][:-1] for k in keys))
        starts = np.flatnonzero(new)
        self.order, self.starts, self.first = order, starts, order[starts]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.least, self.most = self.lowest(ids), self.highest(ids)

    def lowest(self, values: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(values[self.order], self.starts) if len(self.starts) else values[:0]

    def highest(self, values: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(values[self.order], self.starts) if len(self.starts) else values[:0]


# -- entries on their way ---------------------------------------------------------------------


def _pack(columns: list[np.ndarray]) -> bytes:
    """Numbers as byte planes, the first column as differences, as it is sorted: most planes then compress well."""
    first = columns[0].copy()
    first[1:] -= columns[0][:-1]
    return b"".join(c.view(np.uint8).reshape(-1, 8).T.tobytes() for c in [first, *columns[1:]])


def _unpack(data: bytes, width: int, rows: int = -1) -> list[np.ndarray]:
    planes = np.frombuffer(data, np.uint8, count=8 * width * rows if rows >= 0 else -1).reshape(width, 8, -1)
    columns = [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in planes]
    columns[0] = np.cumsum(columns[0], dtype=np.uint64)
    return columns


def _slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)


def _entries(kind: int, columns: list[np.ndarray], slices: int) -> list[tuple[int, int, bytes]]:
    """Entries sorted by their first column, one message for each slice they belong to."""
    homes = _slice_of(columns[0], slices)
    cuts = np.flatnonzero(np.r_[True, homes[1:] != homes[:-1]]) if len(homes) else homes
    ends = [*cuts[1:], len(homes)]
    return [(kind, int(homes[a]), _pack([c[a:b] for c in columns])) for a, b in zip(cuts, ends)]


def _answer(kind: int, messages: list[bytes], length: int) -> list[bytes]:
    """Bits for the entries of each message of one slice, after their number.

    A first digit: another chunk holds it. A digit's stretch, two bits: the
    chunks do not agree on one; there are very many. A stretch: an earlier
    document holds it. An open stretch: one such bit for each window.
    """
    if kind == _STATE:
        return messages
    if kind in (_OPEN, _WINDOW):
        bits, sizes = _answer_open([_unpack_open(m) for m in messages], length)
    else:
        width = {_DIGIT: 1, _ALIKE: 3, _STRETCH: 3}[kind]
        parts = [_unpack(m, width) for m in messages]
        sizes = np.array([len(p[0]) for p in parts])
        columns = [np.concatenate([p[i] for p in parts]) for i in range(width)]
        if kind == _DIGIT:
            bits = _shared(columns[0])
        elif kind == _ALIKE:
            groups = _Groups(columns[:1], columns[1])
            differ = (groups.least != groups.most) | (groups.least == 0)
            many = np.add.reduceat(columns[2][groups.order], groups.starts) > HOT_STRETCHES
            bits, sizes = np.stack([differ, many], axis=1)[groups.of].ravel(), 2 * sizes
        else:
            bits = _later(_Groups(columns[:2], columns[2].view(np.int64)), columns[2].view(np.int64))
    return [len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in np.split(bits, np.cumsum(sizes)[:-1])]


def _pack_open(columns: list[np.ndarray], text: bytes) -> bytes:
    return len(columns[0]).to_bytes(8, "little") + _pack(columns) + text


def _unpack_open(data: bytes) -> tuple[list[np.ndarray], bytes]:
    rows = int.from_bytes(data[:8], "little")
    return _unpack(data[8:], 3, rows), data[8 + 24 * rows :]


def _answer_open(parts: list[tuple[list[np.ndarray], bytes]], length: int) -> tuple[np.ndarray, list[int]]:
    key, ids, counts = (np.concatenate([p[0][i] for p in parts]) for i in range(3))
    counts = counts.astype(np.int64)
    text = np.frombuffer(b"".join(p[1] for p in parts), np.uint8)
    spread = counts + length - 1
    begin = np.cumsum(spread) - spread
    offset = np.cumsum(counts) - counts
    later = np.empty(counts.sum(), bool)
    for some in _batches(key, np.argsort(key), counts):
        own = np.repeat(ids[some].view(np.int64), counts[some])
        groups = _Groups([equal_windows(text, _each(begin[some], counts[some]), length)], own)
        later[_each(offset[some], counts[some])] = _later(groups, own)
    return later, [int(p[0][2].sum()) for p in parts]


def _batches(keys: np.ndarray, order: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted stretches in runs of about ``SORT_ROWS`` windows that part no key."""
    upto = np.cumsum(counts[order])
    at = 0
    while at < len(order):
        end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SORT_ROWS, "right"))
        end = min(len(order), max(end, at + 1))
        end = int(np.searchsorted(keys, keys[order[end - 1]], "right", sorter=order))
        yield order[at:end]
        at = end


def _each(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the runs that begin at ``starts``."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _shared(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.empty(len(keys), bool)
    out[order] = np.r_[False, same] | np.r_[same, False] if len(keys) else False
    return out


def _later(groups: _Groups, ids: np.ndarray) -> np.ndarray:
    return ids > groups.least[groups.of]


# -- one chunk ----------------------------------------------------------------------------------


class _Chunk:
    """The documents of a chunk, their stretches, and what the passes so far have said about these."""

    def __init__(self, texts: list[bytes], ids: list[int | None], length: int, slices: int, number: int):
        self.length, self.slices, self.number = length, slices, number
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.ids = np.array([i or 0 for i in ids], np.int64)
        known = np.array([i is not None for i in ids], bool)
        self.starts, self.counts, self.key = self._stretches(known)
        self.doc = np.searchsorted(self.ends, self.starts, "right")
        self.id = self.ids[self.doc]

    def _stretches(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        total, length = len(self.text), self.length
        gram = gram_width(length)
        whole = np.ones(max(0, total - length + 1), bool)  # windows that lie in one document
        for begin, end, has_id in zip(self.begins, self.ends, known):
            whole[begin if not has_id else max(begin, end - length + 1) : end] = False
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        for at in range(0, len(whole), BLOCK_BYTES):
            inside = whole[at : at + BLOCK_BYTES]
            digit = _least(_gram_hashes(self.text[at : at + len(inside) + length - 1], gram), length - gram + 1)
            new = np.ones(len(inside), bool)
            new[1:] = (digit[1:] != digit[:-1]) | (inside[1:] != inside[:-1])
            starts = np.flatnonzero(new)
            counts = np.diff(np.r_[starts, len(inside)])
            starts, counts = starts[inside[starts]], counts[inside[starts]]
            if len(counts) and counts.max() > length:  # first and last window must cover a stretch
                parts = -(-counts // length)
                step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                starts = np.repeat(starts, parts) + step * length
                counts = np.minimum(length, np.repeat(counts, parts) - step * length)
            found.append((starts + at, counts, mix64(digit[starts])))
        return tuple(np.concatenate(c) for c in zip(*found))

    def _keep(self, chosen: np.ndarray) -> None:
        for name in ("starts", "counts", "key", "doc", "id"):
            setattr(self, name, getattr(self, name)[chosen])

    def find_digits(self) -> None:
        self.groups = _Groups([self.key], self.id)

    def ask_digits(self) -> list[tuple[int, int, bytes]]:
        # 56 bits: a digit that is taken for another costs work, not truth
        return _entries(_DIGIT, [self.key[self.groups.first] & ~np.uint64(255)], self.slices)

    def hear_digits(self, bits: np.ndarray) -> None:
        shared = bits | (self.groups.least != self.groups.most)
        self._keep(shared[self.groups.of])

    def find_stretches(self) -> None:
        first = _window_hashes(self.text, self.starts, self.length)
        last = _window_hashes(self.text, self.starts + self.counts - 1, self.length)
        self.sum = mix64(first * _STEP[0] + mix64(last + _STEP[1]) + self.counts.astype(np.uint64)) | np.uint64(1)
        self.groups = _Groups([self.key], self.sum)
        self.name = mix64(self.key ^ self.sum)
        self.whole = _Groups([self.name, self.sum], self.id)

    def ask_stretches(self) -> list[tuple[int, int, bytes]]:
        alike = np.where(self.groups.least == self.groups.most, self.groups.least, np.uint64(0))
        one = self.whole.first
        many = np.bincount(self.groups.of[one], minlength=len(alike)).astype(np.uint64)
        return [
            *_entries(_ALIKE, [self.key[self.groups.first], alike, many], self.slices),
            *_entries(_STRETCH, [self.name[one], self.sum[one], self.whole.least.view(np.uint64)], self.slices),
        ]

    def hear_stretches(self, differ: np.ndarray, later: np.ndarray) -> None:
        gone = later[self.whole.of] | (self.id > self.whole.least[self.whole.of])
        self.removed = (self.starts[gone], self.counts[gone])
        differ, many = differ.reshape(-1, 2).T
        still = ~gone & differ[self.groups.of]
        self.hot = (still & many[self.groups.of])[still]
        self.name = self.name[still]
        self._keep(still)

    def ask_windows(self) -> list[tuple[int, int, bytes]]:
        """Open stretches under their first digit; hot ones window by window, each under a hash of its own. Where they
        lie goes along, so that the last pass need not find them again."""
        cold, hot = np.flatnonzero(~self.hot), np.flatnonzero(self.hot)
        at, at_id = _each(self.starts[hot], self.counts[hot]), np.repeat(self.id[hot], self.counts[hot])
        sent, places = [], []
        for kind, key, name, starts, counts, ids in (
            (_OPEN, self.key[cold], self.name[cold], self.starts[cold], self.counts[cold], self.id[cold]),
            (_WINDOW, home := _window_hashes(self.text, at, self.length), home, at, np.ones(len(at), np.int64), at_id),
        ):
            # equal ones of one document are sent once
            same = _Groups([name, key, counts.astype(np.uint64)], ids)
            order = np.argsort(key[same.first])
            one, rank = same.first[order], np.argsort(order)
            sent += self._stretch_entries(kind, key[one], same.least[order], starts[one], counts[one])
            begin = np.cumsum(counts[one]) - counts[one]
            places.append((starts, counts, begin[rank[same.of]], ids > same.least[same.of]))
        state = _pack_state([_merged(*self.removed), *places])
        return [*sent, (_STATE, int(self.number), state)]

    def _stretch_entries(
        self, kind: int, key: np.ndarray, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray
    ) -> list[tuple[int, int, bytes]]:
        homes = _slice_of(key, self.slices)
        cuts = np.flatnonzero(np.r_[True, homes[1:] != homes[:-1]]) if len(homes) else homes
        sent = []
        for a, b in zip(cuts, [*cuts[1:], len(homes)]):
            bytes_at = _each(starts[a:b], counts[a:b] + self.length - 1)
            columns = [key[a:b], ids[a:b].view(np.uint64), counts[a:b].astype(np.uint64)]
            sent.append((kind, int(homes[a]), _pack_open(columns, self.text[bytes_at].tobytes())))
        return sent


def _merged(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that follow each other as one."""
    order = np.argsort(starts)
    starts, counts = starts[order], counts[order]
    new = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1] + counts[:-1]]) if len(starts) else starts
    return starts[new], np.add.reduceat(counts, new) if len(new) else counts


def _pack_state(parts: list[tuple[np.ndarray, ...]]) -> bytes:
    """Removed stretches, then for open and hot stretches where they lie, where their bits begin, and whether an earlier
    document of the chunk holds them."""
    out = []
    for arrays in parts:
        out.append(len(arrays[0]).to_bytes(8, "little"))
        # sorted by place, so that differences are small; bytes in planes
        order = np.argsort(arrays[0], kind="stable")
        for i, a in enumerate(arrays):
            a = a[order].astype(np.int64)
            out.append((np.diff(a, prepend=0) if i == 0 else a).view(np.uint8).reshape(-1, 8).T.tobytes())
    return b"".join(out)


def _unpack_state(data: bytes) -> list[list[np.ndarray]]:
    parts, at = [], 0
    for width in (2, 4, 4):
        rows = int.from_bytes(data[at : at + 8], "little")
        at += 8
        arrays = []
        for i in range(width):
            plane = np.frombuffer(data, np.uint8, 8 * rows, at).reshape(8, rows)
            a = np.ascontiguousarray(plane.T).view(np.int64).ravel()
            arrays.append(np.cumsum(a) if i == 0 else a)
            at += 8 * rows
        parts.append(arrays)
    return parts


def _bits(answers: dict[int, list[bytes]], kind: int) -> np.ndarray:
    """The answers of one kind in the order of their entries."""
    parts = [
        np.unpackbits(np.frombuffer(d, np.uint8, offset=8), count=int.from_bytes(d[:8], "little"))
        for d in answers.get(kind, [])
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _by_kind(answers: pa.Table) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for kind, _, data in sorted(zip(*(answers[c].to_pylist() for c in ("kind", "slice", "data")))):
        out.setdefault(kind, []).append(data)
    return out


def _next_entries(chunk: _Chunk, answers: dict[int, list[bytes]], passes: int) -> list[tuple[int, int, bytes]]:
    """Go through the passes that have their answers; what the next one asks."""
    chunk.find_digits()
    if passes == 0:
        return chunk.ask_digits()
    chunk.hear_digits(_bits(answers, _DIGIT))
    chunk.find_stretches()
    if passes == 1:
        return chunk.ask_stretches()
    chunk.hear_stretches(_bits(answers, _ALIKE), _bits(answers, _STRETCH))
    return chunk.ask_windows()


def _results(texts: list[bytes], answers: dict[int, list[bytes]], length: int) -> list[pa.Array]:
    """The result columns of a chunk's documents, from the state that its last pass left and the answers to it."""
    ends = np.cumsum(np.array([len(t) for t in texts], np.int64))
    begins = ends - np.array([len(t) for t in texts], np.int64)
    text = np.frombuffer(b"".join(texts), np.uint8)
    change = np.zeros(len(text) + 1, np.int32)
    if answers.get(_STATE):
        (starts, counts), *open_parts = _unpack_state(answers[_STATE][0])
        spans = [(starts, starts + counts + length - 1)]
        for kind, (starts, counts, begin, later) in zip((_OPEN, _WINDOW), open_parts):
            bits = _bits(answers, kind)
            gone = bits[_each(begin, counts)] | np.repeat(later.astype(bool), counts)
            at = _each(starts, counts)[gone]
            spans.append((at, at + length))
        for a, b in spans:
            np.add.at(change, a, 1)
            np.add.at(change, b, -1)
    gone = np.cumsum(change[:-1]) > 0
    upto = np.r_[0, np.cumsum(gone)]
    n_removed = upto[ends] - upto[begins]
    kept = list(texts)
    edges = [np.zeros(0, np.int64)] * len(texts)
    for i in np.flatnonzero(n_removed):
        own = gone[begins[i] : ends[i]]
        edges[i] = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
        kept[i] = text[begins[i] : ends[i]][~own].tobytes()
    n_spans = np.array([len(e) // 2 for e in edges], np.int64)
    flat = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    runs = pa.StructArray.from_arrays([pa.array(flat[::2]), pa.array(flat[1::2])], names=["start", "end"])
    offsets = pa.array(np.r_[0, np.cumsum(n_spans)].astype(np.int32))
    return [
        pa.array(ends - begins), pa.array(n_removed.astype(np.int64)), pa.array(n_spans),
        pa.ListArray.from_arrays(offsets, runs), pa.array(kept, pa.binary()),
    ]


# -- the job --------------------------------------------------------------------------------------


def _bucketed(docs: DataFrame, total: int, parallel: int) -> DataFrame:
    """The documents as a table bucketed by chunk: all passes read it without a shuffle."""
    least, most = CHUNK_BYTES
    chunks = max(1, -(-total // min(most, max(least, total // 2000))))
    buckets = min(100_000, max(2 * parallel, -(-total // BUCKET_BYTES)))
    salt = F.coalesce(F.xxhash64("_id"), F.xxhash64("_text"))
    placed = docs.withColumn("chunk", F.pmod(F.when(col("_id").isNull(), F.xxhash64("_text")).otherwise(salt), F.lit(chunks)))
    spark = docs.sparkSession
    name = f"tallymark_{uuid.uuid4().hex}"
    (
        placed.repartition(int(buckets), "chunk").write.bucketBy(int(buckets), "chunk").option("compression", "zstd")
        .option("path", scratch_path(spark, "suffix-chunks")).saveAsTable(name)
    )
    return spark.table(name)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` and ``kept``.

    Every byte (UTF-8) is removed that lies in a string of ``length`` bytes which
    also starts in a document with a smaller id; overlaps count, and strings are
    judged on the input. ``spans`` are the maximal removed runs of bytes, ``kept``
    is the rest as binary, as a cut may fall inside a character. Ids are whole
    numbers. A NULL text is empty; rows of equal id do not take from each other;
    a row without an id is neither cut nor a reason to cut; texts shorter than
    ``length`` stay whole; an empty table gives an empty result. Columns of
    ``docs`` named like a result column are replaced.
    """
    if length < 16:
        raise ValueError("windows need at least 16 bytes")
    spark = docs.sparkSession
    own = _parse_datatype_string(RESULT_SCHEMA)
    kept = [c for c in docs.columns if c not in own.fieldNames()]
    carried = docs.select(
        *[col(c).alias(f"_kept{i}") for i, c in enumerate(kept) if c != text_col],
        col(id_col).cast("bigint").alias("_id"),
        F.coalesce(col(text_col).cast("binary"), F.lit(b"")).alias("_text"),
        col(text_col).isNull().alias("_none"),
    )
    parallel = spark.sparkContext.defaultParallelism
    total = docs.agg(F.sum(F.octet_length(col(text_col)))).first()[0] or 0
    slices = max(4 * parallel, -(-total // SLICE_BYTES))
    table = _bucketed(carried, total, parallel)
    asked = table.select("chunk", "_id", "_text")

    def entries(chunk: int, asked: list[tuple[int, int, bytes]]) -> pa.Table:
        kinds, homes, data = zip(*asked) if asked else ((), (), ())
        return pa.table({
            "chunk": pa.array([chunk] * len(asked), pa.int64()), "kind": pa.array(kinds, pa.int32()),
            "slice": pa.array(homes, pa.int64()), "data": pa.array(data, pa.binary()),
        })

    def ask(passes: int):
        def apply(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
            number = key[0].as_py()
            if not rows.num_rows:
                return entries(number, [])
            chunk = _Chunk(rows["_text"].to_pylist(), rows["_id"].to_pylist(), length, slices, number)
            return entries(number, _next_entries(chunk, _by_kind(answers), passes))

        return apply

    def judge(key: tuple, messages: pa.Table) -> pa.Table:
        bits = _answer(key[0].as_py(), messages["data"].to_pylist(), length)
        return messages.set_column(messages.schema.get_field_index("data"), "data", pa.array(bits, pa.binary()))

    answers = spark.createDataFrame([], _ENTRY_SCHEMA)
    for passes in range(3):
        sent = asked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(ask(passes), _ENTRY_SCHEMA)
        answered = sent.groupBy("kind", "slice").applyInArrow(judge, _ENTRY_SCHEMA)
        answers = answers.unionByName(stash(answered, f"suffix-answers-{passes}"))

    carry = [f.name for f in table.schema if f.name.startswith("_kept")]
    out = StructType([
        *(table.schema[c] for c in carry), StructField("_t", table.schema["_text"].dataType), *own.fields
    ])

    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table([pa.array([], f.type) for f in empty], names=out.fieldNames())
        results = _results(rows["_text"].to_pylist(), _by_kind(answers), length)
        text = pa.array([None if n else t for n, t in zip(rows["_none"].to_pylist(), rows["_text"].to_pylist())], pa.binary())
        return pa.table([*(rows[c] for c in carry), text, *results], names=out.fieldNames())

    from pyspark.sql.pandas.types import to_arrow_schema

    empty = list(to_arrow_schema(out))
    done = table.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, out)
    fields = {f"_kept{i}": c for i, c in enumerate(kept)}
    back = {c: col(k) for k, c in fields.items() if c != text_col}
    back[text_col] = col("_t").cast("string")
    return done.select(*[back[c].alias(c) for c in kept], *own.fieldNames())
