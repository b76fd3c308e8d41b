"""Mapping rules as typed builders.

Each builder returns a :class:`Rule`. In a column position a string is a
column name and ``VAL`` is the column being mapped; in a value position a
Python scalar is a literal, and ``ref("x")`` or ``VAL_REF`` is a column.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.casts import safe_cast
from tallymark.functions.names import col

VAL = "val"

_COMPARE = {
    "==": operator.eq,
    "!=": operator.ne,
    "<=": operator.le,
    ">=": operator.ge,
    "<": operator.lt,
    ">": operator.gt,
}

# Cast names that a rule may use, and the Spark type each one means.
CAST_TYPES = {
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "float": "double",
    "double": "double",
    "string": "string",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "date": "date",
}

# Fixed value: the text that the SYS_BATCH_ID constant stands for.
BATCH_ID = "ETL_VALIDATION"


@dataclass(frozen=True)
class Ref:
    name: str


VAL_REF = Ref(VAL)


def ref(name: str) -> Ref:
    return Ref(name)


@dataclass(frozen=True)
class Rule:
    """``build(this)`` gives the Column; ``uses`` names the columns it reads (None: not known)."""

    build: Callable[[str], Column]
    uses: tuple[str, ...] | None = ()
    is_constant: bool = False
    is_cast: bool = False

    def reads(self, this: str) -> set[str] | None:
        """Lower-case names the rule reads when it maps column ``this``."""
        if self.uses is None:
            return None
        return {(this if u == VAL else u).lower() for u in self.uses}


def _named(name: str, this: str) -> Column:
    return col(this if name == VAL else name)


def _value(value, this: str) -> Column:
    if isinstance(value, Ref):
        return _named(value.name, this)
    return value if isinstance(value, Column) else F.lit(value)


def _uses(*operands) -> tuple[str, ...] | None:
    if any(isinstance(o, Column) for o in operands):
        return None
    return tuple(o.name for o in operands if isinstance(o, Ref))


def _of(name: str, fn: Callable[[Column], Column]) -> Rule:
    return Rule(lambda this: fn(_named(name, this)), (name,))


# -- conditions ---------------------------------------------------------------


def if_null(name: str, then, otherwise) -> Rule:
    return Rule(
        lambda this: F.when(_named(name, this).isNull(), _value(then, this)).otherwise(_value(otherwise, this)),
        _join_uses((name,), _uses(then, otherwise)),
    )


def if_not_null(name: str, then, otherwise) -> Rule:
    return Rule(
        lambda this: F.when(_named(name, this).isNotNull(), _value(then, this)).otherwise(_value(otherwise, this)),
        _join_uses((name,), _uses(then, otherwise)),
    )


def if_present_and(present: str, name: str, op: str, value, then, otherwise) -> Rule:
    """``then`` where ``present`` is not NULL and ``name op value`` holds."""
    compare = _COMPARE[op]
    return Rule(
        lambda this: F.when(
            _named(present, this).isNotNull() & compare(_named(name, this), _value(value, this)),
            _value(then, this),
        ).otherwise(_value(otherwise, this)),
        _join_uses((present, name), _uses(value, then, otherwise)),
    )


def if_compare(name: str, op: str, value, then, otherwise) -> Rule:
    """``then`` where ``name op value`` holds; a NULL goes to ``otherwise``."""
    compare = _COMPARE["==" if op == "=" else op]
    return Rule(
        lambda this: F.when(compare(_named(name, this), _value(value, this)), _value(then, this)).otherwise(
            _value(otherwise, this)
        ),
        _join_uses((name,), _uses(value, then, otherwise)),
    )


def if_condition(condition: str, then, otherwise, uses: Sequence[str] | None = None) -> Rule:
    """``IF(condition, a, b)`` with any Spark SQL condition."""
    return Rule(
        lambda this: F.when(F.expr(condition), _value(then, this)).otherwise(_value(otherwise, this)),
        _join_uses(None if uses is None else tuple(uses), _uses(then, otherwise)),
    )


def _join_uses(first: tuple[str, ...] | None, second: tuple[str, ...] | None) -> tuple[str, ...] | None:
    return None if first is None or second is None else first + second


# -- text ---------------------------------------------------------------------


def upper(name: str = VAL) -> Rule:
    return _of(name, F.upper)


def lower(name: str = VAL) -> Rule:
    return _of(name, F.lower)


def trim(name: str = VAL) -> Rule:
    return _of(name, F.trim)


def upper_trim(name: str = VAL) -> Rule:
    return _of(name, lambda c: F.upper(F.trim(c)))


def ltrim(name: str = VAL) -> Rule:
    return _of(name, F.ltrim)


def rtrim(name: str = VAL) -> Rule:
    return _of(name, F.rtrim)


def substring(name: str, start: int, length: int) -> Rule:
    """``length`` characters from the 1-based ``start``."""
    return _of(name, lambda c: F.substring(c, start, length))


def left(name: str, length: int) -> Rule:
    return _of(name, lambda c: F.substring(c, 1, length))


def right(name: str, length: int) -> Rule:
    return _of(name, lambda c: F.right(c, F.lit(length)))


def lpad(name: str, length: int, fill: str) -> Rule:
    """Pad on the left; a longer text is cut to ``length``."""
    return _of(name, lambda c: F.lpad(c, length, fill))


def rpad(name: str, length: int, fill: str) -> Rule:
    """Pad on the right; a longer text is cut to ``length``."""
    return _of(name, lambda c: F.rpad(c, length, fill))


def replace_chain(pairs: Iterable[tuple[str, str]], name: str = VAL) -> Rule:
    """Replace literal texts one after another."""
    pairs = list(pairs)

    def build(c: Column) -> Column:
        for old, new in pairs:
            c = F.replace(c, F.lit(old), F.lit(new))
        return c

    return _of(name, build)


def concat(*parts) -> Rule:
    """Join columns and literals; NULL if any part is NULL."""
    return Rule(lambda this: F.concat(*[_value(p, this) for p in parts]), _uses(*parts))


def plus(*parts) -> Rule:
    """``a + ' ' + b`` on text, the same as :func:`concat`."""
    return concat(*parts)


def to_text(name: str = VAL) -> Rule:
    return _of(name, lambda c: c.cast("string"))


def zfill(length: int, name: str = VAL) -> Rule:
    """Zero-pad the text form to ``length``; a longer text is cut."""
    return _of(name, lambda c: F.lpad(c.cast("string"), length, "0"))


# -- numbers, types, defaults ---------------------------------------------------


def round_to(digits: int, name: str = VAL) -> Rule:
    return _of(name, lambda c: F.round(c, digits))


def coalesce(default, name: str = VAL) -> Rule:
    return Rule(
        lambda this: F.coalesce(_named(name, this), _value(default, this)),
        _join_uses((name,), _uses(default)),
    )


def isnull(default, name: str = VAL) -> Rule:
    """Another spelling of :func:`coalesce`."""
    return coalesce(default, name)


def ifnull(default, name: str = VAL) -> Rule:
    """Another spelling of :func:`coalesce`."""
    return coalesce(default, name)


def cast(type_name: str, name: str = VAL) -> Rule:
    """Cast; a value that does not fit becomes NULL, whatever the session's ANSI setting."""
    spark_type = CAST_TYPES.get(type_name.strip().lower(), type_name)
    return replace(_of(name, lambda c: safe_cast(c, spark_type)), is_cast=True)


def column(name: str = VAL) -> Rule:
    return _of(name, lambda c: c)


def expression(sql: str, uses: Sequence[str] | None = None) -> Rule:
    """Any Spark SQL expression. ``uses`` names the columns it reads, for partial runs."""
    return Rule(lambda this: F.expr(sql), None if uses is None else tuple(uses))


def call(fn: Callable[[Column], Column], name: str = VAL) -> Rule:
    """A Python function from Column to Column."""
    return _of(name, fn)


# -- constants ------------------------------------------------------------------


def constant(value, type_name: str | None = None) -> Rule:
    """A literal column, or one of the named constants.

    Named: CURRENT_TIMESTAMP, CURRENT_DATE, TRUE, FALSE, NULL, IDENTITY (a
    NULL int) and SYS_BATCH_ID. Quoted text is itself, whatever it says. Other
    text is cast to ``type_name``; without one a number that is written as
    numbers print (no leading zeros, no exponent) is a number, and the rest is
    text. An untyped NULL needs ``type_name``.
    """

    def build(_this: str) -> Column:
        c = _constant_column(value, type_name)
        return c.cast(type_name) if type_name else c

    return Rule(build, (), is_constant=True)


# Words that stand for a value of their own.
_NAMED_CONSTANTS = {
    "CURRENT_TIMESTAMP": F.current_timestamp,
    "CURRENT_DATE": F.current_date,
    "TRUE": lambda: F.lit(True),
    "FALSE": lambda: F.lit(False),
    "NULL": lambda: F.lit(None),
    "NONE": lambda: F.lit(None),
    "SYS_BATCH_ID": lambda: F.lit(BATCH_ID),
    "IDENTITY": lambda: F.lit(None).cast("int"),
}
_ARGUMENTS = re.compile(r"\(\s*(?:-?\d+\s*,\s*-?\d+\s*)?\)$")
_QUOTED = re.compile(r"'(.*)'", re.DOTALL)
_PRINTED_NUMBER = re.compile(r"[-+]?(?:0|[1-9]\d{0,17})(\.\d+)?")


def _constant_column(value, type_name: str | None) -> Column:
    if not isinstance(value, str):
        return F.lit(value)
    text = value.strip()
    if quoted := _QUOTED.fullmatch(text):
        return F.lit(quoted[1])
    if named := _NAMED_CONSTANTS.get(_ARGUMENTS.sub("", text.upper())):
        return named()
    if not type_name and (number := _PRINTED_NUMBER.fullmatch(text)):
        return F.lit(float(text) if number[1] else int(text))
    return F.lit(text)
