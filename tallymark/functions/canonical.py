"""Canonical text: the form in which two values are compared.

Two values are equal when their canonical texts are, so that ``5.2``, ``5.20``
and ``'5.200'`` agree whatever types hold them. Where both sides have the same
kind of number, date or time, the values themselves are compared, which decides
the same and is cheaper to hash, sort and shuffle; they become text only in the
difference report. Everything here is one Column expression per value.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.casts import safe_cast
from tallymark.functions.names import col

# Fixed value: decimal places at which doubles are compared when no decimal column sets a scale.
DOUBLE_SCALE = 6

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_TIMES = (T.TimestampType, T.TimestampNTZType)

# Past six decimal places a small decimal may print as 1E-7.
_PLAIN_SCALE = 6


def comparison_scales(source: T.StructType, target: T.StructType, columns: Iterable[str]) -> dict[str, int]:
    """Decimal places per column, from both schemas: the larger scale of two decimals, the scale of
    one decimal, six for a float or double, and no entry where neither side is fractional."""
    left, right = _types(source), _types(target)
    scales = {}
    for name in columns:
        pair = [left.get(name), right.get(name)]
        decimal_scales = [t.scale for t in pair if isinstance(t, T.DecimalType)]
        if decimal_scales:
            scales[name] = max(decimal_scales)
        elif any(isinstance(t, _FLOATING) for t in pair):
            scales[name] = DOUBLE_SCALE
    return scales


def dates_facing_timestamps(source: T.StructType, target: T.StructType, columns: Iterable[str]) -> list[str]:
    """Columns that are a date on one side and a timestamp on the other."""
    left, right = _types(source), _types(target)
    out = []
    for name in columns:
        pair = (left.get(name), right.get(name))
        if any(isinstance(t, T.DateType) for t in pair) and any(isinstance(t, _TIMES) for t in pair):
            out.append(name)
    return out


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


def canonical_text(c: Column, dtype: T.DataType, scale: int | None) -> Column:
    """The text in which ``c`` is compared. ``scale`` is its entry in :func:`comparison_scales`."""
    if isinstance(dtype, _INTEGRAL):
        return c.cast("string")
    if isinstance(dtype, T.DecimalType):
        return _strip_zeros(_plain(c, dtype.scale), dtype.scale)
    if isinstance(dtype, _FLOATING):
        places = DOUBLE_SCALE if scale is None else scale
        number = c.cast("double")
        fixed = safe_cast(F.round(number, places), T.DecimalType(38, places))
        # NaN, the infinities and numbers past 38 digits keep their own text
        return F.coalesce(_strip_zeros(_plain(fixed, places), places), number.cast("string"))
    text = F.trim(c.cast("string"))
    if scale is not None:
        # only where a digit and a point precede the zeros: those of a whole number count
        text = F.when(F.rlike(text, F.lit("[0-9][.][0-9]*$")), _strip_zeros(text, scale or 1)).otherwise(text)
        text = F.when(text == "-0", F.lit("0")).otherwise(text)
    if isinstance(dtype, (T.BooleanType, T.DateType, *_TIMES)):
        return text
    return F.when(F.lower(text).isin("true", "false"), F.lower(text)).otherwise(text)


def comparable(c: Column, own: T.DataType, other: T.DataType, scale: int | None) -> Column:
    """What stands for ``c`` in a comparison with a column of type ``other``: a value whose equality
    decides as canonical text would."""
    if isinstance(own, _INTEGRAL) and isinstance(other, _INTEGRAL):
        return c.cast("bigint")
    if isinstance(own, _FLOATING) and isinstance(other, _FLOATING):
        # adding 0.0 turns -0.0 into 0.0
        return F.round(c.cast("double"), DOUBLE_SCALE) + F.lit(0.0)
    wider = _wider_decimal(own, other)
    if wider is not None:
        return c.cast(wider)
    if own == other and isinstance(own, (T.BooleanType, T.DateType, T.DecimalType, *_TIMES)):
        return c
    return canonical_text(c, own, scale)


def _wider_decimal(own: T.DataType, other: T.DataType) -> T.DecimalType | None:
    """The decimal type that holds both decimals, or a decimal and a whole number, if there is one."""
    if not any(isinstance(t, T.DecimalType) for t in (own, other)):
        return None
    if not all(isinstance(t, (T.DecimalType, *_INTEGRAL)) for t in (own, other)):
        return None
    # the widest whole number has 19 digits
    pair = [t if isinstance(t, T.DecimalType) else T.DecimalType(19, 0) for t in (own, other)]
    scale = max(t.scale for t in pair)
    precision = scale + max(t.precision - t.scale for t in pair)
    return T.DecimalType(precision, scale) if precision <= 38 else None


def comparison_text(c: Column, dtype: T.DataType, scale: int | None) -> Column:
    """The canonical text of a :func:`comparable`."""
    return c if isinstance(dtype, T.StringType) else canonical_text(c, dtype, scale)


def _plain(number: Column, scale: int) -> Column:
    if scale <= _PLAIN_SCALE:
        return number.cast("string")
    return F.call_function("format_number", number, F.lit("0." + "0" * scale))


def _strip_zeros(text: Column, scale: int) -> Column:
    return text if scale == 0 else F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def normalise(
    df: DataFrame,
    columns: Iterable[str],
    scales: Mapping[str, int] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """``columns`` as canonical text and ``keep`` untouched, in one select. NULL stays NULL."""
    types = _types(df.schema)
    scales = scales or {}
    return df.select(
        *[col(k) for k in keep],
        *[canonical_text(col(c), types[c], scales.get(c)).alias(c) for c in columns],
    )


def row_hash(columns: Iterable[str]) -> Column:
    """64-bit hash of the columns. The hash function skips NULLs, so each column's NULL flag is
    hashed too: (NULL, 'a') and ('a', NULL) differ."""
    parts = [p for c in columns for p in (col(c), col(c).isNull())]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def key_text(parts: Iterable[Column]) -> Column:
    """Key parts, already text, joined with ``|``; a NULL part is empty."""
    return F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
