"""Column rules as functions of Arrow arrays, all of them in one pass over the rows.

For rules that no SQL function expresses. Each states the columns it reads, its
type, and what it does with NULL. The code that runs in tasks travels by value,
so that workers need not have this package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType

from tallymark.functions.names import col, find

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that a function gets at a time.
BATCH_ROWS = 8192


@dataclass(frozen=True)
class ArrowRule:
    """``fn`` gets one Arrow array per column of ``inputs`` and returns one as long.

    ``nulls="skip"`` leaves out rows in which an input is NULL: ``fn`` does not
    see them and their result is NULL. ``nulls="pass"`` hands them over.
    """

    target: str
    inputs: Sequence[str]
    dtype: str
    fn: Callable[..., pa.Array]
    nulls: str = "skip"


class ArrowRuleFailed(ValueError):
    """A rule that raised, or gave a result of the wrong length or type: its name and the first row it fails on."""


def apply_arrow_rules(df: DataFrame, rules: Sequence[ArrowRule]) -> DataFrame:
    """``df`` with the targets of all rules, in one Python stage; a target that ``df`` has is replaced.

    Rules read the columns of ``df`` as they come, not each other's results.
    Only the input columns are handed to Python twice; the others pass as they
    are. An empty table gives an empty result.
    """
    if not rules:
        return df
    targets = [r.target for r in rules]
    if len({t.lower() for t in targets}) < len(targets):
        raise ValueError(f"target column(s) ruled twice: {targets}")
    for r in rules:
        if r.nulls not in ("skip", "pass"):
            raise ValueError(f"{r.target}: nulls must be 'skip' or 'pass', not {r.nulls!r}")
    kept = [c for c in df.columns if c.lower() not in {t.lower() for t in targets}]
    inputs = list(dict.fromkeys(find(df.columns, c, r.target) for r in rules for c in r.inputs))
    placed = df.select(*[col(c).alias(f"_k{i}") for i, c in enumerate(kept)], *[col(c).alias(f"_i{i}") for i, c in enumerate(inputs)])
    types = [DataType.fromDDL(r.dtype) for r in rules]
    at = [[len(kept) + inputs.index(find(df.columns, c)) for c in r.inputs] for r in rules]
    out = StructType([
        *placed.schema.fields[: len(kept)], *(StructField(f"_t{i}", t) for i, t in enumerate(types))
    ])
    wanted = [to_arrow_type(t) for t in types]
    width, names = len(kept), out.fieldNames()
    plan = [(r.target, r.fn, r.nulls, a, w) for r, a, w in zip(rules, at, wanted)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                some = batch.slice(start, BATCH_ROWS)
                made = [_run_rule(t, fn, nulls, [some.column(i) for i in a], w) for t, fn, nulls, a, w in plan]
                yield pa.record_batch([*some.columns[:width], *made], names=names)

    return placed.mapInArrow(run, out).toDF(*kept, *targets)


def _run_rule(target: str, fn: Callable, nulls: str, arrays: list[pa.Array], wanted: pa.DataType) -> pa.Array:
    whole = None
    if nulls == "skip" and arrays:
        whole = pc.is_valid(arrays[0])
        for a in arrays[1:]:
            whole = pc.and_(whole, pc.is_valid(a))
        arrays = [a.filter(whole) for a in arrays]
    result = _checked(target, fn, arrays, wanted)
    if whole is None:
        return result
    # results go back to the rows that were not left out
    places = pc.subtract(pc.cumulative_sum(pc.cast(whole, pa.int64())), 1)
    return result.take(pc.if_else(whole, places, pa.scalar(None, pa.int64())))


def _checked(target: str, fn: Callable, arrays: list[pa.Array], wanted: pa.DataType) -> pa.Array:
    rows = len(arrays[0]) if arrays else 0
    try:
        result = fn(*arrays)
        result = result.combine_chunks() if isinstance(result, pa.ChunkedArray) else result
        if len(result) != rows:
            raise ValueError(f"gave {len(result)} values for {rows} rows")
        return result if result.type == wanted else pc.cast(result, wanted)
    except Exception as problem:
        raise ArrowRuleFailed(f"rule {target!r}: {_first_failure(fn, arrays, wanted)}{type(problem).__name__}: {problem}") from problem


def _first_failure(fn: Callable, arrays: list[pa.Array], wanted: pa.DataType) -> str:
    """The values of the first row that fails by itself, if one does."""
    for i in range(len(arrays[0]) if arrays else 0):
        try:
            pc.cast(fn(*[a.slice(i, 1) for a in arrays]), wanted)
        except Exception:
            return f"on {tuple(a[i].as_py() for a in arrays)!r}: "
    return ""
