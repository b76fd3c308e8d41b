"""Row numbers that no single task has to hand out.

``row_number() over (order by k)`` alone moves the whole table to one task.
Here only the sort key and two hashes that identify a row are range-partitioned
and sorted; each position is written to a scratch table, and the number is that
position plus the size of all earlier partitions. Numbers find their rows again
by the hashes. Rows that are equal in every column are interchangeable: they are
counted first and numbered as copies, so that any number of them spreads.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tallymark.functions.names import col
from tallymark.operators.keys import FEW_KEYS, keys_in, keys_not_in, same_keys
from tallymark.sources.scratch import stash

_POSITION = "_tm_position"
_TIE = "_tm_tie"
_IDS = ("_tm_id_a", "_tm_id_b")

# monotonically_increasing_id keeps the partition above bit 33 and the position below it
_PARTITION_BITS = 33

# A key with more rows than this is numbered across several tasks.
HOT_KEY_ROWS = 1_000_000


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    name: str = "rn",
    unique: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows 1, 2, 3, … in the order of ``keys`` (NULL first).

    Rows of equal key come in the order of a hash of the whole row, and may span
    partitions, so a key that holds much of the table does not end up in one
    task. ``unique=True`` promises that there are none, and saves counting equal
    rows first. ``df`` is read twice; one whose plan is not deterministic is
    written out before.
    """
    if not keys:
        raise ValueError("row numbers need at least one key to order by")
    df = _repeatable(df)
    return _with_numbers(df, table_numbers(df, keys, unique, partitions), name)


@dataclass(frozen=True)
class RowNumbers:
    """Numbers by row identity: ``_IDS`` and ``name``; whether rows repeat, so that one identity has several."""

    numbers: DataFrame
    repeats: bool


def table_numbers(
    df: DataFrame, keys: Sequence[str], unique: bool = False, partitions: int | None = None, name: str = "_tm_rn"
) -> RowNumbers:
    """The numbers alone: nothing but keys and identities is moved and written."""
    placed, repeats = _placed(_identified(df, keys), keys, unique, partitions)
    offsets = F.broadcast(_partition_offsets(placed))
    numbered = placed.withColumn("_tm_part", _partition(col(_POSITION))).join(offsets, "_tm_part")
    within = col(_POSITION) - F.shiftleft(col("_tm_part"), _PARTITION_BITS)
    return RowNumbers(numbered.select(*_IDS, (within + col("_tm_before") + 1).alias(name)), repeats)


def rows_by_identity(df: DataFrame, repeats: bool) -> DataFrame:
    """The rows with their identity; of rows that are equal in every column one, if there are any."""
    ids = [c.alias(i) for i, c in zip(_IDS, _identity(df))]
    named = df.select(*[col(c) for c in df.columns], *ids)
    if not repeats:
        return named
    return named.groupBy(*_IDS).agg(*[F.any_value(col(c)).alias(c) for c in df.columns])


def _with_numbers(df: DataFrame, found: RowNumbers, name: str) -> DataFrame:
    number = next(c for c in found.numbers.columns if c not in _IDS)
    joined = rows_by_identity(df, found.repeats).join(found.numbers, list(_IDS))
    return joined.select(*[col(c) for c in df.columns], col(number).alias(name))


def _identity(df: DataFrame) -> list[Column]:
    """Two hashes of the whole row; NULLs count, and a map's entries in the order of their keys."""
    values = [
        F.array_sort(F.map_entries(col(f.name))) if isinstance(f.dataType, MapType) else col(f.name)
        for f in df.schema.fields
    ]
    parts = [p for v in values for p in (v, v.isNull())]
    return [F.xxhash64(F.lit(seed), *parts) for seed in ("a", "b")]


def _identified(df: DataFrame, names: Sequence[str]) -> DataFrame:
    distinct = list(dict.fromkeys(names))
    return df.select(*[col(c) for c in distinct], *[c.alias(i) for i, c in zip(_IDS, _identity(df))])


def _repeatable(df: DataFrame) -> DataFrame:
    return df if df._jdf.queryExecution().analyzed().deterministic() else stash(df, "rows")


def number_within_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rn",
    hot_key_rows: int = HOT_KEY_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, … in the order of ``order`` (NULL first).

    Keys are counted first. Those with no more than ``hot_key_rows`` rows go
    through a plain window. The rows of hotter keys are range-partitioned by key
    and order, so that each is split over many tasks.
    """
    named = [col(k) for k in keys]
    counted = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_tm_rows"))
    hot_keys = stash(counted.filter(col("_tm_rows") > hot_key_rows).select(*named), "hot-keys")
    if hot_keys.isEmpty():
        return number_cold_keys(df, keys, order, name)
    few = hot_keys.count() <= FEW_KEYS
    cold = number_cold_keys(keys_not_in(df, hot_keys, keys, few), keys, order, name)
    return cold.unionByName(_number_hot(keys_in(df, hot_keys, keys, few), keys, order, name, partitions))


def number_cold_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """:func:`number_within_keys` for a table of which it is known that no key is hot."""
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*_ascending(order))
    return df.withColumn(name, F.row_number().over(window).cast("bigint"))


def _number_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, partitions: int | None
) -> DataFrame:
    df = _repeatable(df)
    placed, repeats = _placed(_identified(df, [*keys, *order]), [*keys, *order], False, partitions)
    placed = placed.withColumn("_tm_part", _partition(col(_POSITION)))
    # where each key starts in each partition it reaches into: no more rows than hot keys and partitions together
    spans = placed.groupBy("_tm_part", *[col(k) for k in keys]).agg(
        F.min(_POSITION).alias("_tm_first"), F.count(F.lit(1)).alias("_tm_rows")
    )
    earlier = (
        Window.partitionBy(*[col(k) for k in keys])
        .orderBy("_tm_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = stash(spans.select(
        col("_tm_part").alias("_tm_span_part"),
        *[col(k).alias(f"_tm_key_{i}") for i, k in enumerate(keys)],
        "_tm_first",
        F.coalesce(F.sum("_tm_rows").over(earlier), F.lit(0)).alias("_tm_before"),
    ), "spans")
    same = same_keys(placed, spans, [(k, f"_tm_key_{i}") for i, k in enumerate(keys)])
    numbers = placed.join(spans, same & (col("_tm_part") == col("_tm_span_part"))).select(
        *_IDS, (col(_POSITION) - col("_tm_first") + col("_tm_before") + 1).alias("_tm_rn")
    )
    return _with_numbers(df, RowNumbers(numbers, repeats), name)


def _placed(rows: DataFrame, order: Sequence[str], unique: bool, partitions: int | None) -> tuple[DataFrame, bool]:
    """The rows in sorted range partitions, with their partition and position, as a scratch table, and whether rows
    repeat."""
    if not unique:
        # copies are numbered, so that equal rows can be told apart, and so be split
        counted = rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias("_tm_n"))
        copies = F.explode(F.sequence(F.lit(1).cast("bigint"), col("_tm_n")))
        rows = counted.select(*[col(c) for c in rows.columns], copies.alias(_TIE))
    sort = [*_ascending(order), *[col(c).asc() for c in rows.columns if c in (*_IDS, _TIE)]]
    # with no number given, Spark sizes the partitions by their bytes; each stays one range
    ranged = rows.repartitionByRange(partitions, *sort) if partitions else rows.repartitionByRange(*sort)
    placed = ranged.sortWithinPartitions(*sort).withColumn(_POSITION, F.monotonically_increasing_id())
    if unique:
        return stash(placed, "placed"), False
    copied = Observation("copies")
    written = stash(placed.observe(copied, F.max(_TIE).alias("most")).drop(_TIE), "placed")
    return written, (copied.get["most"] or 0) > 1


def _partition_offsets(placed: DataFrame) -> DataFrame:
    """Rows before each partition. One number per range partition, so the list is short."""
    sizes = placed.groupBy(_partition(col(_POSITION)).alias("part")).count().collect()
    sizes = sorted((r["part"], r["count"]) for r in sizes)
    before = [0, *accumulate(n for _, n in sizes)]
    rows = [(part, start) for (part, _), start in zip(sizes, before)]
    return placed.sparkSession.createDataFrame(rows, "_tm_part bigint, _tm_before bigint")


def _partition(position: Column) -> Column:
    return F.shiftright(position, _PARTITION_BITS)


def _ascending(names: Sequence[str]) -> list[Column]:
    return [col(n).asc_nulls_first() for n in names]
