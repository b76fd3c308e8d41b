"""Global rules: one operation over all the target columns a condition selects."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymark.functions.casts import safe_cast
from tallymark.functions.names import col
from tallymark.functions.rules import CAST_TYPES
from tallymark.functions.types import TYPE_FAMILIES, base_type

TextOp = Callable[..., Column]

TEXT_OPERATIONS: dict[str, TextOp] = {
    "TRIM": F.trim,
    "UPPER": F.upper,
    "LOWER": F.lower,
    "LTRIM": F.ltrim,
    "RTRIM": F.rtrim,
    "STRIP_WHITESPACE": lambda c: F.trim(F.regexp_replace(c, r"\s+", " ")),
    "REPLACE": lambda c, old, new: F.replace(c, F.lit(old), F.lit(new)),
    "REGEX_REPLACE": lambda c, pattern, new: F.regexp_replace(c, pattern, new),
    "LPAD": lambda c, length, fill=" ": F.lpad(c, int(length), fill),
    "RPAD": lambda c, length, fill=" ": F.rpad(c, int(length), fill),
}


def chosen_columns(condition: str, declared: Sequence[tuple[str, str]]) -> list[str]:
    """Names, out of (name, declared type) pairs, that a condition selects.

    Blank or ``all``: every column. ``dtype:FAMILY``, ``col:GLOB`` (case counts)
    and ``exclude:A,B`` select by declared type, by name and by absence.
    """
    kind, _, argument = condition.strip().partition(":")
    kind, argument = kind.strip().lower(), argument.strip()
    if kind in ("", "all"):
        return [name for name, _ in declared]
    if kind == "dtype":
        family = TYPE_FAMILIES.get(argument.upper(), {argument.upper()})
        return [name for name, dtype in declared if base_type(dtype) in family]
    if kind == "col":
        return [name for name, _ in declared if fnmatchcase(name, argument)]
    if kind == "exclude":
        left_out = {part.strip().upper() for part in argument.split(",")}
        return [name for name, _ in declared if name.upper() not in left_out]
    raise ValueError(f"unknown condition {condition!r}")


def apply_global_rule(df: DataFrame, operation: str, parameters: Sequence, columns: Sequence[str]) -> DataFrame:
    """Run one operation over ``columns``. Text operations touch string columns only."""
    operation = operation.strip().upper()
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in types]
    if operation == "CAST":
        (name,) = parameters
        spark_type = CAST_TYPES.get(name.strip().lower(), name)
        changed = {c: safe_cast(col(c), spark_type) for c in present}
    elif operation in TEXT_OPERATIONS:
        build = TEXT_OPERATIONS[operation]
        changed = {c: build(col(c), *parameters) for c in present if isinstance(types[c], StringType)}
    else:
        raise ValueError(f"unknown global operation {operation!r}")
    return df.select(*[changed[c].alias(c) if c in changed else col(c) for c in df.columns])
