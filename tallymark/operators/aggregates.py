"""Grouped rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col, find

_AGGREGATES = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}


def group_rule(
    df: DataFrame, keys: Sequence[str], outputs: Mapping[str, tuple[str, str] | Column]
) -> DataFrame:
    """SUM, COUNT, AVG, MIN or MAX per group: ``{"total": ("sum", "price")}``, or any aggregate Column."""
    aggregates = []
    for name, rule in outputs.items():
        if isinstance(rule, Column):
            aggregates.append(rule.alias(name))
            continue
        function, column = rule
        if function.lower() not in _AGGREGATES:
            raise ValueError(f"{name}: aggregate must be one of {sorted(_AGGREGATES)}, not {function!r}")
        aggregates.append(_AGGREGATES[function.lower()](col(find(df.columns, column))).alias(name))
    return df.groupBy(*[col(find(df.columns, k)) for k in keys]).agg(*aggregates)
