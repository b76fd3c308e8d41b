"""Pairing the rows of keys that repeat: equal rows cancel, and only what is left is paired.

Rows are counted by key and row hash on both sides at once, one narrow shuffle
that folds equal rows where they are read. What both sides hold equally often
is matched; the *surplus* of one side is what differs, and is as large as the
differences are. Where a key has surplus on one side only, its rows are missing
or extra. Where it has on both, its rows are fetched and paired so that they
differ in the fewest cells; a key with very many of them is paired by order
instead, spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallymark.functions.canonical import row_hash
from tallymark.functions.names import col
from tallymark.operators.assignment import number_pairs
from tallymark.operators.keys import same_keys
from tallymark.operators.rownumber import number_within_keys
from tallymark.operators.skipping import KeyBounds, bound_columns, read_bounds, skip_to
from tallymark.sources.scratch import stash
from tallymark.sources.servers import SERVER_COLUMN

#: Surplus rows of one key on either side up to which the pairing has the least cost.
ASSIGN_ROWS = 64
#: Surplus rows that one task pairs, on average.
TASK_ROWS = 20_000

ORDINAL = "_tm_ordinal"
SIDE = "_tm_side"
PAIRED = "_tm_paired"
_HASH = "_tm_hash"
_SURPLUS = "_tm_surplus"


class Surplus:
    """The rows, by key and hash, that one side holds more often than the other, and the counts of both."""

    def __init__(self, source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]):
        self.keys, self.columns = list(keys), list(columns)
        named = [col(k) for k in keys]
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        counted = (
            source.select(*named, row_hash(columns).alias(_HASH), one.alias("src"), none.alias("tgt"))
            .unionByName(target.select(*named, row_hash(columns).alias(_HASH), none.alias("src"), one.alias("tgt")))
            .groupBy(*named, _HASH).agg(F.sum("src").alias("src"), F.sum("tgt").alias("tgt"))
        )
        differs = col("src") != col("tgt")
        watch = Observation("surplus")
        observed = counted.observe(
            watch, F.sum("src").alias("source_rows"), F.sum("tgt").alias("target_rows"),
            F.sum(F.least("src", "tgt")).alias("matched_rows"),
            F.sum(F.abs(col("src") - col("tgt"))).alias("surplus_rows"), F.count_if(differs).alias("groups"),
            *bound_columns(counted, self.keys, differs),
        )
        rest = stash(observed.filter(differs).select(*named, _HASH, (col("src") - col("tgt")).alias(_SURPLUS)), "surplus")
        found = watch.get
        self.source_rows, self.target_rows, self.matched_rows, self.rows, self.groups = (
            found[n] or 0 for n in ("source_rows", "target_rows", "matched_rows", "surplus_rows", "groups")
        )
        self.bounds: list[KeyBounds] = read_bounds(found, self.keys)
        # surplus of both sides under each key: a key may have very many hashes, which are folded first
        sizes = rest.groupBy(*[col(k).alias(f"_tm_key_{i}") for i, k in enumerate(keys)]).agg(
            F.sum(F.greatest(col(_SURPLUS), none)).alias("src_left"), F.sum(F.greatest(-col(_SURPLUS), none)).alias("tgt_left")
        )
        on = same_keys(rest, sizes, [(k, f"_tm_key_{i}") for i, k in enumerate(keys)])
        met = rest.join(sizes, on).select(*[rest[f"`{c}`"] for c in rest.columns], "src_left", "tgt_left")
        # written, as six readers follow
        self.table = stash(met, "surplus-by-key")

    @property
    def contested(self) -> Column:
        return (col("src_left") > 0) & (col("tgt_left") > 0)

    def alone(self, sign: int) -> DataFrame:
        """Keys of the rows that only one side has under their key, one row each: the source's for 1, the target's for -1."""
        rows = self.table.filter(~self.contested & (col(_SURPLUS) * sign > 0))
        return _copies(rows, col(_SURPLUS) * sign).select(*[col(k) for k in self.keys])

    def rows_of(self, side: DataFrame, sign: int, where: Column) -> DataFrame:
        """The surplus rows themselves, one row each. Of equal rows from several servers those of the last servers are
        left over."""
        wanted = self.table.filter(where & (col(_SURPLUS) * sign > 0)).select(
            *[col(k).alias(f"_tm_key_{i}") for i, k in enumerate(self.keys)], col(_HASH).alias("_tm_wanted"),
            (col(_SURPLUS) * sign).alias("_tm_left"), "src_left", "tgt_left",
        )
        tag = [SERVER_COLUMN] if SERVER_COLUMN in side.columns else []
        named = [col(c) for c in [*tag, *self.keys, *self.columns]]
        hashed = side.select(*named, row_hash(self.columns).alias(_HASH))
        near = skip_to(hashed, self.table.select(*[col(k) for k in self.keys], _HASH), [*self.keys, _HASH], self.bounds, self.groups)
        same = same_keys(near, wanted, [(k, f"_tm_key_{i}") for i, k in enumerate(self.keys)])
        met = near.join(wanted, same & (near[_HASH] == wanted["_tm_wanted"]))
        held = met.groupBy(*[col(c) for c in [*tag, *self.keys]], _HASH).agg(
            F.count(F.lit(1)).alias("_tm_n"), *[F.any_value(col(c)).alias(c) for c in (*self.columns, "_tm_left", "src_left", "tgt_left")]
        )
        left = col("_tm_left")
        if tag:
            later = Window.partitionBy(*[col(k) for k in self.keys], _HASH).orderBy(col(SERVER_COLUMN).desc_nulls_last())
            after = F.coalesce(F.sum("_tm_n").over(later.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            left = F.least(col("_tm_n"), F.greatest(left - after, F.lit(0)))
        return _copies(held, left).select(*named, _HASH, "src_left", "tgt_left")


def _copies(rows: DataFrame, count: Column) -> DataFrame:
    counted = rows.withColumn("_tm_copies", count.cast("bigint")).filter(col("_tm_copies") > 0)
    return counted.withColumn("_tm_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), col("_tm_copies")))).drop("_tm_copy", "_tm_copies")


def paired_rows(surplus: Surplus, source: DataFrame, target: DataFrame, hot_key_rows: int) -> DataFrame:
    """The surplus rows of contested keys with their side (0 source, 1 target), a number that pairs them, and whether
    the other side has that number too: a scratch table."""
    keys, columns = surplus.keys, surplus.columns
    tag = F.lit(None).cast("string").alias(SERVER_COLUMN)
    left = surplus.rows_of(source, 1, surplus.contested).withColumn(SIDE, F.lit(0))
    right = surplus.rows_of(target, -1, surplus.contested).withColumn(SIDE, F.lit(1))
    left, right = (r if SERVER_COLUMN in r.columns else r.select("*", tag) for r in (left, right))
    most = F.greatest("src_left", "tgt_left")
    sizes = Observation("contested")
    rows = stash(left.unionByName(right).observe(
        sizes, F.count_if((most > 1) & (most <= ASSIGN_ROWS)).alias("few"), F.count_if(most > ASSIGN_ROWS).alias("many")
    ), "contested")
    shape = [*rows.columns, ORDINAL]
    numbered = rows.filter(most == 1).withColumn(ORDINAL, F.lit(1).cast("bigint"))
    if sizes.get["few"]:
        few = _least_cost(rows.filter((most > 1) & (most <= ASSIGN_ROWS)), keys, columns, surplus.rows)
        numbered = numbered.unionByName(few.select(*shape))
    if sizes.get["many"]:
        # a key with very many rows left is paired by order, which number_within_keys spreads over tasks
        many = number_within_keys(
            rows.filter(most > ASSIGN_ROWS), [*keys, SIDE], [*columns, SERVER_COLUMN], ORDINAL, hot_key_rows
        ).withColumn(ORDINAL, col(ORDINAL).cast("bigint"))
        numbered = numbered.unionByName(many.select(*shape))
    numbered = numbered.withColumn(PAIRED, col(ORDINAL) <= F.least("src_left", "tgt_left"))
    # with one row left on a side nothing was numbered: the rows are read as they are
    return stash(numbered, "paired") if sizes.get["few"] or sizes.get["many"] else numbered


def _least_cost(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], count: int) -> DataFrame:
    """Numbers from the least-cost pairing of each key. Many keys share a task; no key has more than a few rows here."""
    tasks = max(8, -(-count // TASK_ROWS))
    own = [f"_tm_c{i}" for i in range(len(rows.columns))]
    cells = F.array(*[F.xxhash64(col(c), col(c).isNull()) for c in columns], F.lit(0).cast("bigint"))
    placed = rows.select(
        F.pmod(row_hash(keys), F.lit(tasks).cast("bigint")).alias("task"),
        F.to_json(F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)])).alias("key"),
        cells.alias("cells"), col(SIDE).alias("side"), col(_HASH).alias("hash"), col(SERVER_COLUMN).alias("server"),
        *[col(c).alias(o) for c, o in zip(rows.columns, own)],
    )
    out = StructType([*(StructField(o, f.dataType) for o, f in zip(own, rows.schema.fields)), StructField(ORDINAL, LongType())])

    def number(part: pa.Table) -> pa.Table:
        return number_pairs(part, "key", "side", "cells", ["hash", "server"], ORDINAL).select([*own, ORDINAL])

    return placed.groupBy("task").applyInArrow(number, out).toDF(*rows.columns, ORDINAL)
