"""Mapping with a reject table: rows that break a cast or a demand for a value go there, the others go on.

Everything happens in one pass over the source: the mapped rows and what is
wrong with each are written once, and counted by reason as they are written.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallymark.functions.names import col, find
from tallymark.functions.rules import VAL
from tallymark.operators.joins import lookup_join
from tallymark.operators.mapping import apply_mapping
from tallymark.sources.scratch import stash
from tallymark.spec import ColumnMap, TableMap

# Why a row is rejected.
BAD_CAST = "BAD_CAST"
NULL_VALUE = "NULL_VALUE"

_WRONG = "_tm_wrong"
_RAW = "_tm_raw"
_WRONG_TYPE = "array<struct<column_name:string,reason:string,raw_text:string>>"


@dataclass(frozen=True)
class RejectSplit:
    """Good rows in the target's shape; one row per fault (the key columns as text, column, reason, raw text of the
    source); rejected rows, and faults by column and reason."""

    good: DataFrame
    rejects: DataFrame
    rejected_rows: int
    counts: Mapping[tuple[str, str], int]


def split_rejects(df: DataFrame, mapping: TableMap) -> RejectSplit:
    """Map ``df``, and part the rows that the map cannot hold from the others.

    BAD_CAST: a value that is not NULL became NULL by its map's cast, also where
    NULL handling would have filled it. NULL_VALUE: a column whose handling is
    ``error`` is NULL. A row with several faults is rejected once and has a row
    for each in ``rejects``. Both results read one scratch table.
    """
    for join in mapping.joins:
        df = lookup_join(df, join.table, join.keys, join.how, join.fetch)
    casts = [m for m in mapping.kept if _is_own_cast(m)]
    required = [m for m in mapping.kept if m.target in mapping.required]
    faults = [_fault(m.target, BAD_CAST, _source(df, m).cast("string"), _lost(df, m)) for m in casts]
    raw = F.struct(*[
        (_source(df, m).cast("string") if m.source else F.lit(None).cast("string")).alias(f"r{i}") for i, m in enumerate(required)
    ], F.lit(None).cast("string").alias("none"))
    carried = df.select(
        *[col(c) for c in df.columns], F.array_compact(F.array(*faults)).cast(_WRONG_TYPE).alias(_WRONG), raw.alias(_RAW)
    )
    extra = [ColumnMap(c, c, dtype="CARRIED") for c in (_WRONG, _RAW)]
    mapped = apply_mapping(carried, replace(mapping, columns=[*mapping.columns, *extra], joins=()), "off")
    # what a lost value made NULL is one fault, not two
    lost = F.transform(_WRONG, lambda w: w["column_name"])
    nulls = [
        _fault(m.target, NULL_VALUE, col(_RAW)[f"r{i}"], col(m.target).isNull() & ~F.array_contains(lost, F.lit(m.target)))
        for i, m in enumerate(required)
    ]
    wrong = F.concat(_WRONG, F.array_compact(F.array(*nulls)).cast(_WRONG_TYPE))
    every = [(m.target, BAD_CAST) for m in casts] + [(m.target, NULL_VALUE) for m in required]
    watch = Observation("rejects")
    has = [F.array_contains(_names(), F.lit(f"{r}|{n}")) for n, r in every]
    rows = mapped.withColumn(_WRONG, wrong).drop(_RAW)
    written = stash(rows.observe(
        watch, F.count_if(F.size(_WRONG) > 0).alias("rows"), *[F.count_if(h).alias(f"n{i}") for i, h in enumerate(has)]
    ), "rejects")
    found = watch.get
    keys = [m.target for m in mapping.kept if m.key]
    rejects = written.filter(F.size(_WRONG) > 0).select(
        *[col(k).cast("string").alias(k) for k in keys], F.explode(_WRONG).alias("w")
    ).select(*[col(k) for k in keys], "w.column_name", "w.reason", "w.raw_text")
    counts = {e: found[f"n{i}"] for i, e in enumerate(every) if found[f"n{i}"]}
    return RejectSplit(written.filter(F.size(_WRONG) == 0).drop(_WRONG), rejects, found["rows"] or 0, counts)


def _names() -> Column:
    return F.transform(_WRONG, lambda w: F.concat(w["reason"], F.lit("|"), w["column_name"]))


def _is_own_cast(m: ColumnMap) -> bool:
    return m.source is not None and m.rule is not None and (m.kind == "cast" or m.rule.is_cast) and set(m.rule.uses or ("?",)) <= {VAL}


def _source(df: DataFrame, m: ColumnMap) -> Column:
    return col(find(df.columns, m.source, m.target))


def _lost(df: DataFrame, m: ColumnMap) -> Column:
    return _source(df, m).isNotNull() & m.rule.build(find(df.columns, m.source, m.target)).isNull()


def _fault(name: str, reason: str, raw: Column, test: Column) -> Column:
    return F.when(test, F.struct(F.lit(name).alias("column_name"), F.lit(reason).alias("reason"), raw.alias("raw_text")))
