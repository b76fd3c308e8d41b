"""Column name helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def find(columns: Iterable[str], name: str, what: str = "column") -> str:
    """The column called ``name`` in any case, or a ValueError that lists what there is."""
    columns = list(columns)
    if name in columns:
        return name
    hits = [c for c in columns if c.lower() == name.lower()]
    if len(hits) != 1:
        raise ValueError(f"{what}: {name!r} not found in {columns}" if not hits
                         else f"{what}: {name!r} is ambiguous in {columns}")
    return hits[0]


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"column names differ only by case: {df.columns}")
    return df.toDF(*lowered)
