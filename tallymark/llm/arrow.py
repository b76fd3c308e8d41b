"""Computed columns beside the rows they come from."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tallymark.functions.names import col
from tallymark.llm.text import slices

Columns = list[pa.Array]


def with_computed(
    docs: DataFrame, inputs: Sequence[Column], schema: str, start: Callable[[], Callable[[Columns], Columns]], rows: int = 256
) -> DataFrame:
    """All rows and columns of ``docs`` with the columns of ``schema``, which replace columns of the same names.

    ``start`` runs once in each task and returns the function that makes the
    new columns from the ``inputs`` of up to ``rows`` rows. Columns travel by
    position, so their names may be anything.
    """
    own = _parse_datatype_string(schema)
    kept = [c for c in docs.columns if c not in own.fieldNames()]
    carried = docs.select(
        *[col(c).alias(f"_kept{i}") for i, c in enumerate(kept)], *[x.alias(f"_input{i}") for i, x in enumerate(inputs)]
    )
    out = StructType([*carried.schema.fields[: len(kept)], *(StructField(f"_own{i}", f.dataType) for i, f in enumerate(own))])
    names = out.fieldNames()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in slices(batches, rows):
            yield pa.record_batch([*batch.columns[: len(kept)], *compute(batch.columns[len(kept) :])], names=names)

    return carried.mapInArrow(apply, out).toDF(*kept, *own.fieldNames())
