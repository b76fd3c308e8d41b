"""Null-safe key conditions, and the rows of a table whose key another has or lacks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from tallymark.functions.names import col


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of key columns: NULL meets NULL."""
    return reduce(Column.__and__, [left[f"`{a}`"].eqNullSafe(right[f"`{b}`"]) for a, b in pairs])


#: Keys up to which Spark may hold a key set in memory as a whole.
FEW_KEYS = 500_000


def keys_not_in(left: DataFrame, right: DataFrame, keys: Sequence[str], few: bool = False) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks (NULL equals NULL).

    Spark takes a table's size from its files, where keys may be packed very
    tightly, and would broadcast many millions of them. So the tables are sorted
    and merged, unless ``few`` says that ``right`` has no more than ``FEW_KEYS`` rows.
    """
    return _against_keys(left, right, keys, "left_anti", few)


def keys_in(left: DataFrame, right: DataFrame, keys: Sequence[str], few: bool = False) -> DataFrame:
    """Rows of ``left`` whose key ``right`` has (NULL equals NULL); ``few`` as in :func:`keys_not_in`."""
    return _against_keys(left, right, keys, "left_semi", few)


def _against_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, few: bool) -> DataFrame:
    other = right.select(*[col(k).alias(f"_tm_key_{i}") for i, k in enumerate(keys)])
    other = other if few else other.hint("merge")
    return left.join(other, same_keys(left, other, [(k, f"_tm_key_{i}") for i, k in enumerate(keys)]), how)
