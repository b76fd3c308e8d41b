"""Casts that give NULL for what does not fit.

``try_cast`` does that by itself, but it raises and catches an error inside for
each value that fails, which costs microseconds a row. Where many values may
fail, most are told apart first by a cheap test that no castable value fails.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EDGE = r"[\x00-\x20\x7F]*"
_WHOLE = rf"^{_EDGE}[-+]?[0-9]+(?:\.[0-9]*)?{_EDGE}$"
_FRACTION = rf"\.[0-9]*{_EDGE}$"
_NUMBER = rf"^{_EDGE}[-+]?(?:\p{{Nd}}|\.\p{{Nd}}|[iI][nN][fF]|[nN][aA][nN])"
_BOOLEAN = rf"^{_EDGE}(?i:t|true|y|yes|1|f|false|n|no|0){_EDGE}$"

_INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def safe_cast(c: Column, to: str | T.DataType) -> Column:
    """``c`` as type ``to``; a value that does not fit becomes NULL, whatever the session's ANSI setting.

    Text with a fraction is cut to a whole number where ``to`` is one: ``'1.5'``
    gives 1, as a double of 1.5 does.
    """
    kind = T.DataType.fromDDL(to) if isinstance(to, str) else to
    tests = []
    cast = c.try_cast(kind)
    if type(kind) in _INTEGRAL_BITS:
        whole = F.regexp_replace(c.cast("string"), _FRACTION, "").try_cast(kind)
        cast = F.when(F.typeof(c) == "string", whole).otherwise(cast)
        bound = 2.0 ** (_INTEGRAL_BITS[type(kind)] - 1)
        tests = [_if_text(c, _WHOLE), _if_floating(c, lambda d: (d >= -bound - 1) & (d <= bound))]
    elif isinstance(kind, T.DecimalType):
        bound = float(10 ** (kind.precision - kind.scale))
        tests = [_if_text(c, _NUMBER), _if_floating(c, lambda d: (d > -bound) & (d < bound))]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        tests = [_if_text(c, _NUMBER)]
    elif isinstance(kind, T.BooleanType):
        tests = [_if_text(c, _BOOLEAN)]
    if not tests:
        return cast
    passes = tests[0] if len(tests) == 1 else tests[0] & tests[1]
    return F.when(passes, cast)


# A column's type is a constant to the optimizer, so that only the test for that type is left in the plan.


def _if_text(c: Column, pattern: str) -> Column:
    return (F.typeof(c) != "string") | c.cast("string").rlike(pattern)


def _if_floating(c: Column, within) -> Column:
    return ~F.typeof(c).isin("double", "float") | within(c.try_cast("double"))
