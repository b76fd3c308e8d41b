"""One type per column over servers that do not agree on it.

Types form a lattice: whole numbers widen to the widest, whole numbers and
decimals to a decimal that holds both, either with a double to a double, a date
with a timestamp to a timestamp, and whatever else differs to text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tallymark.functions.canonical import canonical_text
from tallymark.functions.names import col

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_DOUBLE_DIGITS = 15

# What becomes of a server's column.
SAME, WIDENED, LOSSY, TEXT, ABSENT = "SAME", "WIDENED", "LOSSY", "TEXT", "ABSENT"

WIDENING_SCHEMA = "column_name string, server string, own_type string, common_type string, change string"


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text where there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if all(isinstance(t, _WHOLE) for t in (a, b)):
        return max((a, b), key=lambda t: _DIGITS[type(t)])
    exact = (*_WHOLE, T.DecimalType)
    if all(isinstance(t, exact) for t in (a, b)):
        pair = [t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0) for t in (a, b)]
        scale = max(t.scale for t in pair)
        digits = scale + max(t.precision - t.scale for t in pair)
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if all(isinstance(t, (*exact, T.FloatType, T.DoubleType)) for t in (a, b)):
        return T.DoubleType()
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if all(isinstance(t, times) for t in (a, b)):
        return T.TimestampType() if any(isinstance(t, T.TimestampType) for t in (a, b)) else T.TimestampNTZType()
    return T.StringType()


def change(own: T.DataType, common: T.DataType) -> str:
    """Whether values of ``own`` keep all they have as ``common``."""
    if own == common:
        return SAME
    if isinstance(common, T.StringType):
        return TEXT
    if isinstance(common, T.DoubleType) and isinstance(own, (*_WHOLE, T.DecimalType)):
        digits = own.precision if isinstance(own, T.DecimalType) else _DIGITS[type(own)]
        return WIDENED if digits <= _DOUBLE_DIGITS else LOSSY
    if isinstance(common, T.TimestampType) and not isinstance(own, T.TimestampType):
        return LOSSY  # it depends on the session's zone
    return WIDENED


def common_schema(servers: Mapping[str, DataFrame]) -> T.StructType:
    """Every column of any server, in order of appearance, with its common type. Names match in any case."""
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for df in servers.values():
        for f in df.schema.fields:
            key = f.name.lower()
            names.setdefault(key, f.name)
            types[key] = common_type(types[key], f.dataType) if key in types else f.dataType
    # with three or more types the order in which they meet must not matter
    for key in types:
        own = _types_of(servers.values(), key)
        types[key] = reduce(common_type, sorted(own, key=lambda t: (isinstance(t, T.StringType), t.simpleString())))
        types[key] = T.StringType() if any(common_type(types[key], t) != types[key] for t in own) else types[key]
    return T.StructType([T.StructField(names[k], types[k]) for k in names])


def _types_of(frames: Iterable[DataFrame], key: str) -> list[T.DataType]:
    return [f.dataType for df in frames for f in df.schema.fields if f.name.lower() == key]


def widening(servers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column and server: its own type, the common one, and what the change does to its values."""
    schema = common_schema(servers)
    rows = []
    for field in schema.fields:
        for server, df in servers.items():
            own = _types_of([df], field.name.lower())
            kind = change(own[0], field.dataType) if own else ABSENT
            rows.append((field.name, server, own[0].simpleString() if own else None, field.dataType.simpleString(), kind))
    return next(iter(servers.values())).sparkSession.createDataFrame(rows, WIDENING_SCHEMA)


def widen(servers: Mapping[str, DataFrame], allow: Iterable[str] = (WIDENED, TEXT, LOSSY)) -> dict[str, DataFrame]:
    """Each server with the columns it has in their common types. A change that ``allow`` lacks is an error."""
    schema, allowed = common_schema(servers), {SAME, *allow}
    refused, out = [], {}
    for server, df in servers.items():
        have = {f.name.lower(): f for f in df.schema.fields}
        chosen = []
        for field in schema.fields:
            own = have.get(field.name.lower())
            if own is None:
                continue
            kind = change(own.dataType, field.dataType)
            if kind not in allowed:
                refused.append(f"{server}.{own.name} from {own.dataType.simpleString()} to {field.dataType.simpleString()} is {kind}")
            chosen.append(_as(col(own.name), own.dataType, field.dataType).alias(field.name))
        out[server] = df.select(*chosen)
    if refused:
        raise ValueError("; ".join(refused))
    return out


def _as(c: Column, own: T.DataType, common: T.DataType) -> Column:
    if own == common:
        return c
    if isinstance(common, T.StringType):
        # the text in which values are compared, so that 5 and 5.00 of two servers agree
        return canonical_text(c, own, None)
    return c.cast(common)

