"""Jaccard similarity join over word n-grams with MinHash banding.

Two documents are candidates where they share all minimum hashes of a band
(called a tree here, and its length the prefix). The length is the longest, up
to ``depth``, at which a pair at the threshold is found with the target recall.
It follows from the settings alone, so there is no LSH forest: no signatures are
sorted, and nothing is shortened on the data. Groups of equal bands (nodes) are
checked by signature, which leaves small clusters of likely neighbours; every pair inside a cluster is then verified on the whole
n-gram sets, so a pair that the bands missed is found too if others
link its ends.

Documents with equal n-gram sets are one node from the start. Large nodes
and large clusters are cut into blocks, and each pair of blocks is a
task's group of bounded size that returns counts and a spanning forest of its
links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm.groups import Roots, connected_components, sorted_groups
from tallymark.llm.text import slices, texts, windows, words
from tallymark.sources.scratch import stash

_KEPT_HASHES = 500_000


@dataclass(frozen=True)
class ForestSettings:
    width: int = 5
    threshold: float = 0.8
    trees: int = 20
    depth: int = 8
    #: share of pairs at the threshold that some tree must bring together
    target_recall: float = 0.999
    #: a signature may tell the similarity this much too low
    slack: float = 0.15
    #: documents in a block
    block: int = 256

    def recall(self, depth: int) -> float:
        """Probability that a pair at the threshold shares a prefix of this length in some tree."""
        return 1 - (1 - self.threshold**depth) ** self.trees

    def prefix(self) -> int:
        """The prefix length, shortened from the full depth until the recall is reached."""
        length = self.depth
        while length > 1 and self.recall(length) < self.target_recall:
            length -= 1
        return length


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_HASHES:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


@cache
def _hashes() -> _Hashes:
    return _Hashes()


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of all words together if there are fewer."""
    found = words(text)
    hashed = np.fromiter(map(_hashes().__getitem__, found), np.uint64, len(found))
    return np.unique(windows(hashed, min(width, len(hashed)))) if len(found) else hashed


def node_of(found: np.ndarray) -> int | None:
    """The name of an n-gram set; None for an empty one."""
    return xxhash.xxh64_intdigest(found.tobytes()) - (1 << 63) if len(found) else None


@cache
def _factors(n: int) -> np.ndarray:
    return np.random.default_rng(20240607).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(found: np.ndarray, n: int) -> np.ndarray:
    """``n`` minimum hashes, 32 bits of each."""
    factors = _factors(n)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 4096):
        np.minimum(least, np.multiply.outer(factors, found[start : start + 4096]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


# -- the trie's nodes, checked by signature -------------------------------------------------


def _spanning(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """For each group the edges of a forest that spans documents whose signatures agree often enough."""
    for group in sorted_groups(batches, 3):
        nodes = group.column(3).to_numpy()
        signs = np.frombuffer(b"".join(group.column(4).to_pylist()), np.uint8).reshape(len(nodes), -1)
        roots = Roots(len(nodes))
        # what chance agreement of one byte adds
        need = (least + (1 - least) / 256) * signs.shape[1]
        for i in range(len(nodes) - 1):
            if roots.parts == 1:
                break
            agree = (signs[i + 1 :] == signs[i]).sum(axis=1)
            for j in np.flatnonzero(agree >= need).tolist():
                roots.join(i, i + 1 + j)
        yield from _edges(nodes, roots)


def _edges(nodes: np.ndarray, roots: Roots) -> Iterator[pa.RecordBatch]:
    tops = [roots.find(i) for i in range(len(nodes))]
    below = [i for i, t in enumerate(tops) if t != i]
    if below:
        yield pa.record_batch(
            [pa.array(nodes[below]), pa.array(nodes[[tops[i] for i in below]])], names=["a", "b"]
        )


def _blocked(rows: DataFrame, key: str, size: str, node: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks that its block is in: columns key, one, two before the others.

    A group of up to ``block`` rows has one block; a larger one has as many as
    it needs, and a row goes to as many groups as there are blocks.
    """
    blocks = F.ceil(col(size) / F.lit(float(block)))
    own = F.pmod(F.xxhash64(node, F.lit("block")), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks.cast("bigint") - 1))
    dealt = rows.withColumn("_own", own.cast("bigint")).withColumn("_other", other)
    dealt = dealt.withColumns({"one": F.least("_own", "_other"), "two": F.greatest("_own", "_other")})
    rest = [c for c in rows.columns if c not in (key, size)]
    placed = dealt.select(key, "one", "two", *rest)
    return placed.repartition(key, "one", "two").sortWithinPartitions(key, "one", "two", node)


# -- verification on whole sets ----------------------------------------------------------------


def overlaps(sets: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct sets. Values that only one set has are left out; the
    others are compared as rows of a matrix, some at a time."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    number = np.cumsum(fresh) - 1
    shared = np.bincount(number)[number] > 1
    number, owner = np.cumsum(fresh & shared)[shared] - 1, owner[shared]
    common = np.zeros((n, n))
    total = int(number[-1]) + 1 if len(number) else 0
    for start in range(0, total, chunk):
        a, b = np.searchsorted(number, [start, start + chunk])
        rows = np.zeros((n, min(chunk, total - start)), np.float32)
        rows[owner[a:b], number[a:b] - start] = 1
        common += rows @ rows.T
    return common


LINK_SCHEMA = "node bigint, links bigint, copy_links bigint, root bigint"


def _verified(batches: Iterator[pa.RecordBatch], settings: ForestSettings) -> Iterator[pa.RecordBatch]:
    """For each pair of blocks: every node's links to nodes and to documents, and a root it hangs together with."""
    for group in sorted_groups(batches, 3):
        one, two = group.column(1)[0].as_py(), group.column(2)[0].as_py()
        # a node's text may have come more than once
        nodes, at = np.unique(group.column(3).to_numpy(), return_index=True)
        blocks = group.column(4).to_numpy()[at]
        copies = group.column(5).to_numpy()[at]
        packed = group.column(6)
        sets = [np.frombuffer(packed[int(i)].as_py(), np.uint64) for i in at]
        common = overlaps(sets)
        sizes = np.array([len(s) for s in sets], np.float64)
        linked = common >= settings.threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
        np.fill_diagonal(linked, False)
        # pairs within a block belong to that block's own group
        counted = linked if one == two else linked & (blocks[:, None] != blocks[None, :])
        roots = Roots(len(nodes))
        for i in range(len(nodes)):
            if roots.parts == 1:
                break
            for j in np.flatnonzero(linked[i, :i]).tolist():
                roots.join(i, j)
        yield pa.record_batch(
            [
                pa.array(nodes), pa.array(counted.sum(axis=1).astype(np.int64)),
                pa.array((counted @ copies).astype(np.int64)),
                pa.array(nodes[[roots.find(i) for i in range(len(nodes))]]),
            ],
            names=["node", "links", "copy_links", "root"],
        )


# -- the join -------------------------------------------------------------------------------------


def link(
    docs: DataFrame, settings: ForestSettings = ForestSettings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, class_id, copy_of, n_links, n_text_links).

    ``copy_of`` is the least id of the documents with the same n-grams,
    ``n_links`` the number of other documents whose similarity reaches the
    threshold, copies included, ``n_text_links`` that of different n-gram sets,
    and ``class_id`` the least id of what links hold together. A text without
    words (NULL or empty) links to nothing and is its own class; a text of
    fewer words than an n-gram is one n-gram. Repeated rows are copies; NULL ids
    never name a class unless it has no other. An empty table gives an empty
    result.
    """
    length = settings.prefix()
    n = settings.trees * length
    width = settings.width
    source = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in slices(batches, 256):
            nodes, keys, signs = [], [], []
            for text in texts(batch.column(1)):
                found = shingles(text, width)
                node = node_of(found)
                nodes.append(node)
                # one signature for each set that the task meets
                if node is None or node in met:
                    keys.append(None)
                    signs.append(None)
                    continue
                met.add(node)
                least = signature(found, n)
                keys.append([xxhash.xxh64_intdigest(p.tobytes(), t) - (1 << 63) for t, p in enumerate(least.reshape(settings.trees, length))])
                signs.append(least.astype(np.uint8).tobytes())
            yield pa.record_batch(
                [batch.column(0), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                names=["doc_id", "node", "keys", "signs"],
            )

    described = stash(source.mapInArrow(describe, "doc_id bigint, node bigint, keys array<bigint>, signs binary"), "forest-docs")
    # one row per n-gram set; equal sets are folded before they move
    nodes = stash(
        described.filter(col("node").isNotNull()).groupBy("node").agg(
            F.min("doc_id").alias("copy_of"), F.count(F.lit(1)).alias("copies")
        ),
        "forest-nodes",
    )
    signed = stash(
        described.filter(col("keys").isNotNull()).select("node", "keys", "signs").dropDuplicates(["node"]), "forest-signatures"
    )
    members = signed.select("node", F.explode("keys").alias("key"))
    shared = stash(
        members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(col("size") > 1).withColumnRenamed("key", "of_key"),
        "forest-prefixes",
    )
    # merge joins at every size: what is shuffled then grows as the input does, and nothing large is broadcast
    together = stash(members.join(shared.hint("merge"), col("key") == col("of_key")).select("key", "size", "node"), "forest-members")
    signs = signed.select(col("node").alias("of_node"), "signs")
    candidates = together.join(signs, col("node") == col("of_node")).select("key", "size", "node", "signs")
    least = settings.threshold - settings.slack
    edges = _blocked(candidates, "key", "size", "node", settings.block).mapInArrow(
        lambda batches: _spanning(batches, least), "a bigint, b bigint"
    )
    clusters = stash(connected_components(edges), "forest-clusters")

    sizes = clusters.groupBy(col("component").alias("of_component")).agg(F.count(F.lit(1)).alias("size"))
    wanted = (
        clusters.join(sizes, col("component") == col("of_component"))
        .join(nodes.withColumnRenamed("node", "of_node"), col("node") == col("of_node"))
        .select(col("copy_of").alias("of_id"), "component", "size", col("node").alias("wanted_node"), "copies")
    )
    wanted = stash(wanted, "forest-wanted")
    sourced = source.join(wanted.hint("merge"), col("doc_id").eqNullSafe(col("of_id"))).select(
        "component", "size", "wanted_node", "copies", "text"
    )

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = [shingles(t, width) for t in texts(batch.column(4))]
            # an id may stand for several texts: only the one that was meant
            meant = [i for i, (f, w) in enumerate(zip(found, batch.column(2).to_pylist())) if node_of(f) == w]
            at = pa.array(meant, pa.int64())
            yield pa.record_batch(
                [*(batch.column(i).take(at) for i in range(4)), pa.array([found[i].tobytes() for i in meant], pa.binary())],
                names=["component", "size", "node", "copies", "shingles"],
            )

    sets = sourced.mapInArrow(collect, "component bigint, size bigint, node bigint, copies bigint, shingles binary")
    blocks = F.pmod(F.xxhash64("node", F.lit("block")), F.ceil(col("size") / F.lit(float(settings.block)))).cast("bigint")
    sets = sets.withColumn("own", blocks).select("component", "size", "node", "own", "copies", "shingles")
    verified = stash(
        _blocked(sets, "component", "size", "node", settings.block).mapInArrow(
            lambda batches: _verified(batches, settings), LINK_SCHEMA
        ),
        "forest-links",
    )
    counted = verified.groupBy(col("node").alias("counted_node")).agg(
        F.sum("links").alias("links"), F.sum("copy_links").alias("copy_links")
    )
    joined = connected_components(verified.select(col("node").alias("a"), col("root").alias("b"))).withColumnRenamed(
        "node", "joined_node"
    )
    known = (
        nodes.join(counted, col("node") == col("counted_node"), "left")
        .join(joined, col("node") == col("joined_node"), "left")
        .select(
            "node", "copy_of", "copies", F.coalesce("component", "node").alias("component"),
            F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("copy_links", F.lit(0)).alias("copy_links"),
        )
    )
    known = stash(known, "forest-known")
    classes = known.groupBy(col("component").alias("of_component")).agg(F.min("copy_of").alias("class_id"))
    results = stash(
        known.join(classes, col("component") == col("of_component")).select(
            col("node").alias("of_node"), "class_id", "copy_of", "links", (col("copy_links") + col("copies") - 1).alias("all_links")
        ),
        "forest-results",
    )
    return described.select("doc_id", "node").join(results, col("node") == col("of_node"), "left").select(
        "doc_id",
        F.when(col("node").isNull(), col("doc_id")).otherwise(col("class_id")).alias("class_id"),
        F.when(col("node").isNull(), col("doc_id")).otherwise(col("copy_of")).alias("copy_of"),
        F.coalesce("all_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_text_links"),
    )


def keep_one(docs: DataFrame, settings: ForestSettings = ForestSettings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their class: one document of each group of near copies. Rows that share
    their id stay or go together; rows without an id stay."""
    linked = link(docs, settings, id_col, text_col)
    gone = stash(
        linked.filter(col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.when(col("doc_id") == col("class_id"), 1).otherwise(0)).alias("stays"))
        .filter(col("stays") == 0).select(col("doc_id").alias("gone_id")),
        "forest-gone",
    )
    return docs.join(gone, col(id_col).cast("bigint") == col("gone_id"), "left_anti")
