"""Lookup joins, positional joins, and the null-safe join of a comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.names import col, find
from tallymark.operators.keys import same_keys
from tallymark.operators.rownumber import _IDS, _repeatable, rows_by_identity, table_numbers

_HOW = {"left": "left", "inner": "inner", "right": "right", "full": "full"}


def lookup_join(
    main: DataFrame,
    other: DataFrame,
    keys: Sequence[tuple[str, str]],
    how: str = "left",
    fetch: Sequence[str] | Mapping[str, str] = (),
) -> DataFrame:
    """Join ``other`` to ``main`` on all the (main column, other column) pairs.

    Only the key and ``fetch`` columns of ``other`` are read; ``fetch`` may map
    a column to its name in the result. Spark broadcasts ``other`` when it is
    small. When it is not, a main key with very many rows must be split, which
    Spark can do for inner and left joins only; so RIGHT and FULL are put
    together from those and the rows of ``other`` that nothing in ``main`` meets.
    """
    mode = _HOW.get(how.strip().lower())
    if mode is None:
        raise ValueError(f"how must be one of {sorted(_HOW)}, not {how!r}")
    if not keys:
        raise ValueError("a lookup join needs at least one key pair")
    fetched = dict(fetch) if isinstance(fetch, Mapping) else {c: c for c in fetch}
    clash = {c.lower() for c in main.columns} & {c.lower() for c in fetched.values()}
    if clash:
        raise ValueError(f"fetched column(s) already in the main table: {sorted(clash)}; rename them in fetch")
    pairs = [(find(main.columns, a, "main key"), find(other.columns, b, "lookup key")) for a, b in keys]
    right = other.select(
        *[col(b).alias(f"_tm_key_{i}") for i, (_, b) in enumerate(pairs)],
        *[col(find(other.columns, c, "fetch")).alias(out) for c, out in fetched.items()],
    )
    on = reduce(Column.__and__, [main[f"`{a}`"] == right[f"_tm_key_{i}"] for i, (a, _) in enumerate(pairs)])
    result = [*[col(c) for c in main.columns], *[col(c) for c in fetched.values()]]
    met = main.join(right, on, "left" if mode in ("left", "full") else "inner").select(*result)
    if mode in ("left", "inner"):
        return met
    main_keys = main.select(*[col(a).alias(f"_tm_main_{i}") for i, (a, _) in enumerate(pairs)]).distinct()
    unmet_on = reduce(
        Column.__and__, [right[f"_tm_key_{i}"] == main_keys[f"_tm_main_{i}"] for i in range(len(pairs))]
    )
    unmet = right.join(main_keys, unmet_on, "left_anti").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in main.schema.fields],
        *[col(c) for c in fetched.values()],
    )
    return met.unionByName(unmet)


def positional_join(
    main: DataFrame,
    others: Sequence[tuple[DataFrame, Sequence[str]]],
    main_keys: Sequence[str],
    unique: bool = False,
) -> DataFrame:
    """Align tables by position: row n of each, in the order of its own keys.

    An inner join on the row number, so the shortest table sets the length.
    Only keys and row identities are sorted and numbered; the rows are joined to
    the numbers that met. The number itself is kept as ``rn``. ``unique=True`` promises that every
    table's keys are unique (see :func:`number_rows`).
    """
    seen = {"rn"}
    for table, keys in [(main, main_keys), *others]:
        if not keys:
            raise ValueError("row numbers need at least one key to order by")
        clash = seen & {c.lower() for c in table.columns}
        if clash:
            raise ValueError(f"column(s) in more than one table: {sorted(clash)}")
        seen |= {c.lower() for c in table.columns}
    tables = [_repeatable(table) for table in (main, *(t for t, _ in others))]
    found = [table_numbers(t, keys, unique) for t, keys in zip(tables, [main_keys, *(k for _, k in others)])]
    # numbers meet first, then each table's rows come to them once
    numbers = [
        f.numbers.select(col("_tm_rn").alias("rn"), *[col(i).alias(f"{i}_{n}") for i in _IDS]) for n, f in enumerate(found)
    ]
    result = reduce(lambda a, b: a.join(b, "rn"), numbers)
    for n, (table, f) in enumerate(zip(tables, found)):
        rows = rows_by_identity(table, f.repeats)
        result = result.join(rows, reduce(Column.__and__, [result[f"{i}_{n}"] == rows[i] for i in _IDS])).drop(*_IDS)
    return result.select("rn", *[col(c) for t in tables for c in t.columns])


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[col(c).alias(prefix + c) for c in df.columns])


def null_safe_join(source: DataFrame, target: DataFrame, keys: Sequence[str], how: str, few: bool = False) -> DataFrame:
    """Join two sides of a comparison; columns become ``src_…`` and ``tgt_…``. ``few`` as in :func:`keys_not_in`."""
    left, right = prefixed(source, "src_"), prefixed(target, "tgt_")
    right = right if few else right.hint("merge")
    return left.join(right, same_keys(left, right, [(f"src_{k}", f"tgt_{k}") for k in keys]), how)
