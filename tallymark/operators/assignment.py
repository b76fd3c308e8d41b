"""Least-cost pairing of the rows of one key.

The functions run inside tasks. They travel by value, so that workers need not
have this package.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def assign(cost: np.ndarray) -> np.ndarray:
    """For each row of a cost table with no more rows than columns the column it takes, at the least total cost.

    Shortest augmenting paths with row and column potentials; equal costs go to
    the first column.
    """
    rows, columns = cost.shape
    taken_by = np.full(columns + 1, -1)  # the last column stands for the row that is being placed
    row_gain, column_gain = np.zeros(rows), np.zeros(columns + 1)
    for row in range(rows):
        taken_by[columns] = row
        at = columns
        reach = np.full(columns, np.inf)
        came_from = np.full(columns, columns)
        done = np.zeros(columns + 1, bool)
        while taken_by[at] >= 0:
            done[at] = True
            here = taken_by[at]
            reduced = cost[here] - row_gain[here] - column_gain[:columns]
            better = ~done[:columns] & (reduced < reach)
            reach[better], came_from[better] = reduced[better], at
            nearest = int(np.argmin(np.where(done[:columns], np.inf, reach)))
            step = reach[nearest]
            row_gain[taken_by[done]] += step
            column_gain[done] -= step
            reach[~done[:columns]] -= step
            at = nearest
        while at != columns:
            taken_by[at] = taken_by[came_from[at]]
            at = came_from[at]
    out = np.full(rows, -1)
    held = np.flatnonzero(taken_by[:columns] >= 0)
    out[taken_by[held]] = held
    return out


def pair_rows(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 1, 2, … for the rows of both sides, given as cell hashes, so that rows of equal number differ in the fewest
    cells overall; rows of the longer side that stay alone get the numbers after."""
    swapped = len(left) > len(right)
    few, many = (right, left) if swapped else (left, right)
    cost = (few[:, None, :] != many[None, :, :]).sum(axis=2).astype(float)
    partner = assign(cost)
    numbers = np.zeros(len(many), np.int64)
    numbers[partner] = np.arange(1, len(few) + 1)
    alone = numbers == 0
    numbers[alone] = np.arange(len(few) + 1, len(many) + 1)
    own = np.arange(1, len(few) + 1)
    return (numbers, own) if swapped else (own, numbers)


def number_pairs(rows: pa.Table, key: str, side: str, cells: str, order: list[str], name: str) -> pa.Table:
    """``rows`` with a number that pairs the rows of side 0 with those of side 1 under each key."""
    rows = rows.sort_by([(c, "ascending") for c in (key, side, *order)])
    keys = rows[key].to_pylist()
    sides = np.asarray(rows[side])
    width = len(rows[cells][0]) if rows.num_rows else 0
    matrix = np.asarray(rows[cells].combine_chunks().flatten()).reshape(rows.num_rows, width)
    numbers = np.zeros(rows.num_rows, np.int64)
    at = 0
    while at < rows.num_rows:
        end = at
        while end < rows.num_rows and keys[end] == keys[at]:
            end += 1
        middle = at + int((sides[at:end] == 0).sum())
        numbers[at:middle], numbers[middle:end] = pair_rows(matrix[at:middle], matrix[middle:end])
        at = end
    return rows.append_column(name, pa.array(numbers))
