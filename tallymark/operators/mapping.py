"""Running a table map over a DataFrame."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame

from tallymark.functions.global_rules import apply_global_rule, chosen_columns
from tallymark.functions.names import col, find
from tallymark.functions.nulls import effective_handling, fill
from tallymark.operators.checks import refuse_nulls, require_no_nulls
from tallymark.operators.joins import lookup_join
from tallymark.spec import ColumnMap, LookupJoin, TableMap


def apply_mapping(df: DataFrame, mapping: TableMap, null_check: str = "count") -> DataFrame:
    """Lookup joins, then column rules in order, then global rules, then the target's column order.

    ``null_check`` says what happens to NULLs in columns whose handling is
    ``error``. ``count`` counts them now, in a pass of its own, and raises
    :class:`NullsFound`. ``inline`` needs no pass: the job that later reads such
    a column fails on the first NULL. ``off`` lets them through.
    """
    if null_check not in ("count", "inline", "off"):
        raise ValueError(f"null_check must be 'count', 'inline' or 'off', not {null_check!r}")
    for join in mapping.joins:
        df = lookup_join(df, join.table, join.keys, join.how, join.fetch)
    df = apply_column_rules(df, mapping.columns)
    declared = [(m.target, m.dtype) for m in mapping.kept]
    for rule in sorted(mapping.global_rules, key=lambda r: r.order):
        df = apply_global_rule(df, rule.operation, rule.parameters, chosen_columns(rule.condition, declared))
    if mapping.hook is not None:
        df = conform_columns(apply_hook(df, mapping.hook), mapping.targets)
    if null_check == "count" and mapping.required:
        require_no_nulls(df, mapping.required)
    return refuse_nulls(df, mapping.required) if null_check == "inline" else df


def apply_column_rules(df: DataFrame, maps: Sequence[ColumnMap]) -> DataFrame:
    """The target columns, made by their rules and null handling in order.

    A rule sees the columns before it as they came out, NULLs filled. Rules
    that do not read each other's output share one select, so that even a wide
    table keeps a shallow plan.
    """
    kept = [m for m in maps if m.kind != "drop"]
    sourced = {m.target: col(find(df.columns, m.source, m.target)) for m in kept if m.source is not None}
    df = df.withColumns(sourced) if sourced else df
    pending: dict[str, ColumnMap] = {}
    for m in kept:
        if pending and _reads_any(m, pending):
            df, pending = _run(df, list(pending.values())), {}
        pending[m.target.lower()] = m
    df = _run(df, list(pending.values()))
    return conform_columns(df, [m.target for m in kept])


def _reads_any(m: ColumnMap, pending: dict[str, ColumnMap]) -> bool:
    if m.rule is None:
        return False
    reads = m.rule.reads(m.target)
    return True if reads is None else bool(reads & set(pending))


def _run(df: DataFrame, maps: Sequence[ColumnMap]) -> DataFrame:
    ruled = {m.target: _ruled(m) for m in maps if m.rule is not None}
    df = df.withColumns(ruled) if ruled else df
    filled: dict[str, Column] = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for m in maps:
        handling = effective_handling(m)
        if m.kind != "constant" and handling not in ("", "error", "fill_empty"):
            name = find(df.columns, m.target)
            filled[name] = fill(col(name), types[name], handling, m.target)
    return df.withColumns(filled) if filled else df


def _ruled(m: ColumnMap) -> Column:
    c = m.rule.build(m.target)
    if m.kind == "constant":
        # an untyped NULL would have no type at all
        from tallymark.functions.types import declared_type_to_spark

        return c.cast(declared_type_to_spark(m.dtype)[0])
    return c


def apply_hook(df: DataFrame, fn: Callable[..., DataFrame], rulebook: dict | None = None) -> DataFrame:
    """Run a user's own DataFrame function, with its rulebook if it takes one."""
    result = fn(df) if rulebook is None else fn(df, rulebook)
    if not isinstance(result, DataFrame):
        raise TypeError(f"a transform must return a DataFrame, not {type(result).__name__}")
    return result


def conform_columns(df: DataFrame, names: Sequence[str], missing: str = "error") -> DataFrame:
    """Exactly these columns in this order. ``missing="warn"`` goes on without those not there."""
    have = {c.lower(): c for c in df.columns}
    absent = [n for n in names if n.lower() not in have]
    if absent and missing == "error":
        raise ValueError(f"column(s) {absent} not found in {df.columns}")
    if absent:
        warnings.warn(f"column(s) {absent} not found, left out", stacklevel=2)
    return df.select(*[col(have[n.lower()]).alias(n) for n in names if n.lower() in have])


def select_partial(mapping: TableMap, columns: Sequence[str]) -> TableMap:
    """The part of a map that makes ``columns``: those, the keys of the target and of the source,
    and every column their rules read."""
    by_name = {m.target.lower(): m for m in mapping.kept}
    unknown = sorted(c for c in columns if c.strip().lower() not in by_name)
    if unknown:
        raise ValueError(f"no such target column(s): {unknown}; there are {mapping.targets}")
    wanted = {c.strip().lower() for c in columns}
    wanted |= {m.target.lower() for m in mapping.kept if m.key or m.source_key}
    by_source: dict[str, set[str]] = {}
    for m in mapping.kept:
        if m.source is not None:
            by_source.setdefault(m.source.lower(), set()).add(m.target.lower())
    queue = list(wanted)
    while queue:
        m = by_name[queue.pop()]
        reads = m.rule.reads(m.target) if m.rule is not None else set()
        if reads is None:
            raise ValueError(f"{m.target}: state in uses= which columns its expression reads")
        needed = {t for r in reads for t in ({r} if r in by_name else by_source.get(r, set()))}
        queue.extend(needed - wanted)
        wanted |= needed
    chosen = [m for m in mapping.kept if m.target.lower() in wanted]
    return replace(mapping, columns=tuple(chosen), joins=tuple(j for j in mapping.joins if _needed(j, chosen)))


def _needed(join: LookupJoin, maps: Sequence[ColumnMap]) -> bool:
    """Whether a map reads what the join fetches. Other than LEFT joins stay, they choose rows."""
    fetched = set(join.fetch.values() if isinstance(join.fetch, Mapping) else join.fetch)
    read = {m.source.lower() for m in maps if m.source}
    for m in maps:
        read |= (m.rule.reads(m.target) or set()) if m.rule is not None else set()
    return join.how.strip().lower() != "left" or bool({c.lower() for c in fetched} & read)
