"""Groups of rows inside tasks, and connected components across them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.sources.scratch import stash


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` columns (whole numbers), from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for start, end in zip(edges[:-2], edges[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(start, end - start)])
            held = []
        held.append(batch.slice(edges[-2], edges[-1] - edges[-2]))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


class Roots:
    """Which of n items hang together."""

    def __init__(self, n: int):
        self.of = list(range(n))
        self.parts = n

    def find(self, i: int) -> int:
        while self.of[i] != i:
            self.of[i] = self.of[self.of[i]]
            i = self.of[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.of[max(a, b)] = min(a, b)
            self.parts -= 1


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (a, b); a component is called by its least node.

    Alternates two steps that keep what hangs together: each node's larger
    neighbours move to its least neighbour, then so do its smaller ones. Chains
    halve and stars are fixed points, so the rounds grow with the logarithm of a
    component's size. Every round is written to the shared folder; nothing comes
    to the driver but a checksum.
    """
    current = _oriented(edges)
    seen = None
    for _ in range(rounds):
        current = _small_star(_large_star(current))
        state = tuple(current.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return current.select(col("a").alias("node"), col("b").alias("component")).unionByName(
        current.select(col("b").alias("node"), col("b").alias("component")).distinct()
    )


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    pairs = edges.filter(col("a") != col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return stash(pairs.distinct(), "components")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(col("b").alias("a"), col("a").alias("b")))
    least = stash(
        both.groupBy("a").agg(F.min("b").alias("least")).select(col("a").alias("of"), F.least("a", "least").alias("least")),
        "components-least",
    )
    moved = both.join(least, col("a") == col("of")).filter(col("b") > col("a"))
    return _oriented(moved.select(col("b").alias("a"), col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = stash(edges.groupBy(col("a").alias("of")).agg(F.min("b").alias("least")), "components-least")
    moved = edges.join(least, col("a") == col("of"))
    return _oriented(
        moved.select("b", "least").select(col("b").alias("a"), col("least").alias("b")).unionByName(
            least.select(col("of").alias("a"), col("least").alias("b"))
        )
    )
