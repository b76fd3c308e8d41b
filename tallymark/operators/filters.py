"""Row filters. Literals take the column's own type, so that filters reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from tallymark.functions.casts import safe_cast
from tallymark.functions.names import col, find
from tallymark.operators.skipping import key_set_bounds, range_filter, skip_to


def where(df: DataFrame, condition: str | Column | None) -> DataFrame:
    """Filter by a Spark SQL condition or a Column; nothing to do for ``None`` or ``""``."""
    if condition is None or (isinstance(condition, str) and not condition.strip()):
        return df
    return df.filter(F.expr(condition) if isinstance(condition, str) else condition)


def date_window(
    df: DataFrame,
    mode: str = "full",
    date_from: str | None = None,
    from_col: str | None = None,
    date_to: str | None = None,
    to_col: str | None = None,
    inclusive_day: bool = False,
) -> DataFrame:
    """Rows between two dates, each bound on its own column, both ends included.

    ``date_to`` on a timestamp column means midnight at its start;
    ``inclusive_day=True`` takes that whole day.
    """
    if mode not in ("full", "range"):
        raise ValueError(f"mode must be 'full' or 'range', not {mode!r}")
    if mode == "full":
        return df
    if date_from is None and date_to is None:
        raise ValueError("mode 'range' needs date_from or date_to")
    condition = None
    if date_from is not None:
        condition = _bounded(df, "from_col", from_col, date_from, lambda c, v: c >= v)
    if date_to is not None:
        if inclusive_day:
            upper = _bounded(df, "to_col", to_col, date_to, lambda c, v: c < v, days=1)
        else:
            upper = _bounded(df, "to_col", to_col, date_to, lambda c, v: c <= v)
        condition = upper if condition is None else condition & upper
    return df.filter(condition)


def _bounded(df: DataFrame, what: str, name: str | None, value: str, test, days: int = 0) -> Column:
    if not name:
        raise ValueError(f"a date bound needs {what}")
    name = find(df.columns, name, what)
    dtype = df.schema[name].dataType
    literal = F.lit(value)
    if days:
        literal = F.date_add(literal.cast(DateType()), days)
        literal = literal.cast("string") if isinstance(dtype, StringType) else literal
    return test(col(name), literal.cast(dtype))


def pk_filter(
    df: DataFrame,
    keys: str | Sequence[str],
    mode: str = "full",
    lower=None,
    upper=None,
    values: Sequence | DataFrame | None = None,
) -> DataFrame:
    """Rows by primary key: ``full`` all, ``range`` between two values, ``set`` one of ``values``.

    ``values`` are semi-joined, however many there are: Spark broadcasts them
    only if they are small. Their ranges and a Bloom filter of bounded size are
    applied before that, the ranges in the scan itself; that takes an aggregate
    over ``values``. A list lies on the driver; hand large sets over as a
    DataFrame with the key columns.
    """
    keys = [find(df.columns, k, "key") for k in ([keys] if isinstance(keys, str) else keys)]
    if mode == "full":
        return df
    if mode == "range":
        if len(keys) != 1:
            raise ValueError("a key range needs exactly one key column")
        if lower is None and upper is None:
            raise ValueError("a key range needs a lower or an upper bound")
        dtype = df.schema[keys[0]].dataType
        if lower is not None:
            df = df.filter(col(keys[0]) >= F.lit(lower).cast(dtype))
        if upper is not None:
            df = df.filter(col(keys[0]) <= F.lit(upper).cast(dtype))
        return df
    if mode != "set":
        raise ValueError(f"mode must be 'full', 'range' or 'set', not {mode!r}")
    if values is None:
        raise ValueError("a key set needs values")
    if isinstance(values, DataFrame):
        # each key once: one that the table repeats very often is folded before it moves
        wanted = values.select(*[col(find(values.columns, k, "key table")).alias(k) for k in keys]).distinct()
        return _named_by(df, wanted, keys)
    # each value takes its key's type; one that does not fit matches nothing
    rows = [tuple(v) if isinstance(v, (tuple, list)) else (v,) for v in values]
    as_text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    schema = ", ".join(f"k{i} string" for i in range(len(keys)))
    wanted = df.sparkSession.createDataFrame(as_text, schema).select(
        *[safe_cast(F.col(f"k{i}"), df.schema[k].dataType).alias(k) for i, k in enumerate(keys)]
    )
    return _named_by(df, wanted.distinct(), keys)


def _named_by(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    bounds, count = key_set_bounds(wanted, keys)
    # NULL names nothing here
    near = skip_to(df, wanted, keys, [replace(b, has_null=False) for b in bounds], count)
    ranges = range_filter(df, wanted, keys[0])
    return (near if ranges is None else near.filter(ranges)).join(wanted, list(keys), "left_semi")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows, to look at."""
    return df.limit(rows)
