"""Centroid clustering of integer vectors with an equal-average equal-variance nearest search.

Centroids are sorted by the mean of their components. For a vector the search
starts at the centroid whose mean is nearest and goes outward on both sides.
Two bounds of the squared distance save most exact distances: ``d`` times the
squared difference of means, whose growth also ends the walk on a side, and that
plus the squared difference of the deviations from the mean. What passes both
is measured exactly in integers, so bounds only ever save work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.sources.scratch import stash

#: Largest absolute value of a component: squared distances then stay below 2 ** 63.
MAX_COMPONENT = 1 << 27
#: Vectors that are searched at a time.
BATCH_ROWS = 4096

RESULT_SCHEMA = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, components: int, scale: int) -> DataFrame:
    """``vec_id`` and ``v``, the vector as whole numbers, of the rows that can be clustered."""
    raw = F.transform(col(vector_col), lambda x: x.cast("double"))
    whole = F.transform(raw, lambda x: F.floor(F.lit(float(scale)) * x))
    fits = F.forall(
        raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.floor(F.lit(float(scale)) * x)) <= F.lit(MAX_COMPONENT))
    )
    return vectors.filter(F.coalesce((F.size(col(vector_col)) == components) & fits, F.lit(False))).select(
        col(id_col).cast("bigint").alias("vec_id"), whole.cast("array<int>").alias("v")
    )


class NearestCentroid:
    """Nearest centroids by squared Euclidean distance; of equally near ones the smallest number."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.centroids, self.sums = centroids[self.order], sums[self.order]
        self.deviations = _deviations(self.centroids)
        self.measured = 0

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid of each row."""
        count, width = vectors.shape
        k = len(self.sums)
        sums, deviations = vectors.sum(axis=1), _deviations(vectors)
        best = np.full(count, np.iinfo(np.int64).max)
        label = np.full(count, k, np.int64)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        active = np.arange(count)
        padded = np.r_[self.sums.astype(np.float64), np.inf, -np.inf]  # indices k and -1 lie outside
        while len(active):
            to_left = np.abs(sums[active] - padded[left[active]])
            to_right = np.abs(padded[right[active]] - sums[active])
            go_left = to_left <= to_right
            # both sides only get farther: nothing is left to find once the nearer one is too far
            bound = np.minimum(to_left, to_right) ** 2 / width
            alive = ~_exceeds(bound, best[active]) & np.isfinite(bound)
            active, go_left, bound = active[alive], go_left[alive], bound[alive]
            seen = np.where(go_left, left[active], right[active])
            left[active] -= go_left
            right[active] += ~go_left
            spread = (deviations[active] - self.deviations[seen]) ** 2
            near = ~_exceeds(bound + spread, best[active])
            rows, seen = active[near], seen[near]
            gap = vectors[rows] - self.centroids[seen]
            distance = np.einsum("ij,ij->i", gap, gap)
            self.measured += len(rows)
            number = self.order[seen]
            closer = (distance < best[rows]) | ((distance == best[rows]) & (number < label[rows]))
            best[rows[closer]], label[rows[closer]] = distance[closer], number[closer]
        return label, best


def _deviations(vectors: np.ndarray) -> np.ndarray:
    centred = vectors - vectors.mean(axis=1, keepdims=True)
    return np.sqrt(np.einsum("ij,ij->i", centred, centred))


def _exceeds(bound: np.ndarray, best: np.ndarray) -> np.ndarray:
    # the bounds are doubles: they reject only where rounding cannot be the reason
    return bound > best * (1 + 1e-6) + 1e-3


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(-1, width)


def _search_batches(
    batches: Iterator[pa.RecordBatch], index: NearestCentroid, width: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            some = batch.slice(at, BATCH_ROWS)
            vectors = _matrix(some.column(some.schema.get_field_index("v")), width)
            yield (some, vectors, *index.search(vectors))


def _updated(kept: DataFrame, centroids: list[list[int]], width: int) -> list[list[int]]:
    """Centroids after one round: floored means of their vectors, or as before where there are none."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        totals, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for _, vectors, label, _ in _search_batches(batches, NearestCentroid(np.array(centroids, np.int64)), width):
            counts += np.bincount(label, minlength=k)
            np.add.at(totals, label, vectors)
        some = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array(some, pa.int64()), pa.array(np.c_[counts, totals][some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "totals"],
        )

    # one row a task and cluster; the sums of each component meet by key
    parts = kept.select("v").mapInArrow(add_up, "cluster bigint, totals array<bigint>")
    each = parts.select("cluster", F.posexplode("totals").alias("i", "n"))
    rows = each.groupBy("cluster", "i").agg(F.sum(col("n").cast("decimal(38,0)")).alias("n")).collect()
    sums = {(r["cluster"], r["i"]): int(r["n"]) for r in rows}
    return [
        [sums[c, i + 1] // sums[c, 0] for i in range(width)] if (c, 0) in sums else old
        for c, old in enumerate(centroids)
    ]


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 64,
    clusters: int = 40,
    rounds: int = 5,
    scale: int = 256,
    seed: str = "2:",
) -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    A vector is kept if it has exactly ``components`` components, none NULL or
    non-finite, and none beyond ``MAX_COMPONENT`` once scaled and floored.
    Centroids start as the vectors with the smallest ``sha256(seed + id)``
    (equal ids in the order of their components; fewer vectors than ``clusters``
    give fewer centroids). Each round assigns all vectors and replaces every
    non-empty centroid by the floored mean of its vectors; then vectors are
    assigned once more. A NULL id is hashed as an empty text; rows of equal id
    all count; other columns are left out; an empty table gives an empty result.
    To the driver come the centroids and one sum per cluster and component.
    """
    spark = vectors.sparkSession
    kept = stash(kept_vectors(vectors, id_col, vector_col, components, scale), "centroid-vectors")
    drawn = F.sha2(F.concat(F.lit(seed), F.coalesce(col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = [list(r["v"]) for r in kept.select(drawn.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()]
    for _ in range(rounds if centroids else 0):
        centroids = _updated(kept, centroids, components)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = NearestCentroid(np.array(centroids, np.int64))
        for some, _, label, distance in _search_batches(batches, index, components):
            yield pa.record_batch(
                [some.column(0), pa.array(label.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    schema = "vec_id bigint, cluster int, distance bigint"
    if not centroids:
        return spark.createDataFrame([], f"vec_id bigint, {RESULT_SCHEMA}")
    assigned = stash(kept.select("vec_id", "v").mapInArrow(assign, schema), "centroid-assigned")
    spent = assigned.groupBy("cluster").agg(F.sum(col("distance").cast("decimal(38,0)")).alias("spent")).collect()
    total = sum(int(r["spent"]) for r in spent)
    facts = spark.createDataFrame(
        [
            (r["cluster"], int(r["spent"]), total, hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest())
            for r in spent
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    # at most ``clusters`` rows
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
