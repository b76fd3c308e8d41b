"""Null handling: what a mapped column does with NULL."""

from __future__ import annotations

import re
from datetime import date
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

_NOTE_TOKEN = re.compile(r"'[^']+'|[^\s']\S*")


def handling_from_notes(notes: str) -> str:
    """``fill:<v>`` where a free-text note states a default, else ``""``.

    A note states one by the word DEFAULT before a value, which may be quoted,
    or by UNSPECIFIED IF NULL. A value that IF NULL follows comes before others.
    """
    words = _NOTE_TOKEN.findall(notes or "")
    upper = [w.upper() for w in words]
    stated = [i + 1 for i, w in enumerate(upper[:-1]) if w == "DEFAULT"]
    conditional = [i for i, pair in enumerate(zip(upper[1:], upper[2:])) if pair == ("IF", "NULL")]
    for i in conditional:
        if i in stated or upper[i] == "UNSPECIFIED":
            return "fill:" + ("UNSPECIFIED" if upper[i] == "UNSPECIFIED" else words[i].strip("'"))
    return "fill:" + words[stated[0]].strip("'") if stated else ""


def effective_handling(column_map) -> str:
    """The stated handling, else the one its notes imply; keywords in lower case."""
    stated = (column_map.null_handling or "").strip() or handling_from_notes(column_map.notes)
    if stated.lower().startswith("fill:"):
        return "fill:" + stated[5:]
    keyword = stated.lower()
    if keyword not in ("", "error", "fill_zero", "fill_empty"):
        raise ValueError(f"{column_map.target}: unknown null handling {stated!r}")
    return keyword


def fill(c: Column, dtype: DataType, handling: str, name: str) -> Column:
    """Fill NULL as ``handling`` says. A filler the column's type cannot hold is an error here,
    when the plan is built, not in the middle of a run."""
    if handling in ("", "error", "fill_empty"):
        return c
    filler = "0" if handling == "fill_zero" else handling[5:]
    _check_filler(filler, dtype, name)
    if isinstance(dtype, StringType):
        # an integer filler is written as a number: fill:007 fills '7'
        filler = str(int(filler)) if re.fullmatch(r"\s*[+-]?\d+\s*", filler) else filler
    return F.coalesce(c, F.lit(filler).cast(dtype))


def _check_filler(filler: str, dtype: DataType, name: str) -> None:
    if not literal_fits(filler, dtype):
        raise ValueError(f"{name}: cannot fill a {dtype.simpleString()} column with {filler!r}")


# Bits of the whole-number types.
_BITS = {ByteType: 8, ShortType: 16, IntegerType: 32, LongType: 64}


def literal_fits(text: str, dtype: DataType) -> bool:
    """Whether a literal can be cast to a type without an error or a loss."""
    text = text.strip()
    if isinstance(dtype, StringType):
        return True
    if isinstance(dtype, BooleanType):
        return text.lower() in ("true", "false", "0", "1")
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        day = re.match(r"(\d{4})-(\d{1,2})-(\d{1,2})(?:$|[T ])", text)
        try:
            return day is not None and date(*map(int, day.groups())) is not None
        except ValueError:
            return False
    if not isinstance(dtype, NumericType):
        return False
    try:
        number = Decimal(text)
    except InvalidOperation:
        return False
    if not number.is_finite():
        return False
    if type(dtype) in _BITS:
        bound = 1 << (_BITS[type(dtype)] - 1)
        return number == number.to_integral_value() and -bound <= number < bound
    if isinstance(dtype, DecimalType):
        shifted = number.scaleb(dtype.scale)
        return shifted == shifted.to_integral_value() and abs(shifted) < Decimal(10) ** dtype.precision
    return True
