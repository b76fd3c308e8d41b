"""What a caller declares: column maps, lookup joins, global rules, servers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import DataType, StructType

from tallymark.functions import rules

KINDS = ("direct", "rename", "cast", "derived", "constant", "drop")


@dataclass(frozen=True)
class ColumnMap:
    """How one target column is made.

    ``rule`` is a :class:`tallymark.functions.rules.Rule`, or a string: a Spark
    SQL expression (``val`` is not special there), or the value of a map of kind
    ``constant``. Within a rule a column name means the target column of that
    name if the map has one, as it stands after the maps before this one;
    otherwise the untouched source column.
    """

    target: str
    source: str | None = None
    rule: rules.Rule | str | None = None
    dtype: str = "VARCHAR"
    kind: str | None = None
    key: bool = False
    source_key: bool = False
    nullable: bool = True
    null_handling: str = ""
    notes: str = ""
    force_dtype: str | None = None

    def __post_init__(self):
        kind = self.kind or self._infer_kind()
        if kind not in KINDS:
            raise ValueError(f"{self.target}: unknown kind {kind!r}, use one of {KINDS}")
        if kind in ("cast", "derived", "constant") and self.rule is None:
            raise ValueError(f"{self.target}: kind {kind!r} needs a rule")
        if kind in ("direct", "rename", "drop") and self.source is None:
            raise ValueError(f"{self.target}: kind {kind!r} needs a source column")
        object.__setattr__(self, "kind", kind)
        if isinstance(self.rule, str):
            made = rules.constant(self.rule) if kind == "constant" else rules.expression(self.rule)
            object.__setattr__(self, "rule", made)

    def _infer_kind(self) -> str:
        if self.source is None:
            is_constant = self.rule is None or getattr(self.rule, "is_constant", False)
            return "constant" if is_constant else "derived"
        if self.rule is None:
            return "direct" if self.source.lower() == self.target.lower() else "rename"
        return "derived"


@dataclass(frozen=True)
class GlobalRule:
    """One operation over every target column its condition selects."""

    order: int
    operation: str
    parameters: tuple = ()
    condition: str = ""


@dataclass(frozen=True)
class LookupJoin:
    """A table joined to the main table on one or more key pairs."""

    table: DataFrame
    keys: Sequence[tuple[str, str]]
    how: str = "left"
    fetch: Sequence[str] | Mapping[str, str] = ()


@dataclass(frozen=True)
class TableMap:
    """Every rule that turns one server's rows into the target's shape."""

    columns: Sequence[ColumnMap]
    global_rules: Sequence[GlobalRule] = ()
    joins: Sequence[LookupJoin] = ()
    hook: Callable[[DataFrame], DataFrame] | None = None

    def __post_init__(self):
        names = [m.target.lower() for m in self.kept]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"target column(s) mapped twice: {repeated}")

    @property
    def kept(self) -> list[ColumnMap]:
        return [m for m in self.columns if m.kind != "drop"]

    @property
    def targets(self) -> list[str]:
        return [m.target for m in self.kept]

    @property
    def keys(self) -> list[str]:
        return [m.target for m in self.kept if m.key]

    @property
    def required(self) -> list[str]:
        from tallymark.functions.nulls import effective_handling

        return [m.target for m in self.kept
                if m.kind != "constant" and effective_handling(m) == "error"]

    @property
    def forced_types(self) -> dict[str, DataType]:
        """Spark's types of the columns that declare a type to be compared as."""
        from tallymark.functions.types import declared_value_type

        return {m.target: declared_value_type(m.force_dtype) for m in self.kept if m.force_dtype}


@dataclass(frozen=True)
class DeclaredColumn:
    """A column as a table definition declares it."""

    name: str
    dtype: str
    nullable: bool = True


@dataclass(frozen=True)
class ServerSource:
    """One source system: where its extract lies and which rows to take."""

    name: str
    path: str
    format: str = "csv"
    schema: StructType | None = None
    where: str | Column | None = None
    options: Mapping[str, str] = field(default_factory=dict)
