"""Which parts of two tables can differ, from digests of key buckets.

Every row has a hash of its key and compared columns, and every key a bucket.
The digest of a bucket is the difference of two sums of row hashes, one over
each side, which no order of rows changes: it is folded where the rows are read,
so that one row a task and bucket is all that moves. Buckets that hold the same
rows on both sides end at zero, and equal tables end after this one pass. The
buckets that do not are cut into finer ones in a second pass; only rows of
unequal fine buckets go on to be compared key by key. The first pass also sums
one fine bucket of each coarse one apart. Where nearly all of these differ, a
second pass would leave nothing out: it is not made, and all rows go on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.canonical import row_hash
from tallymark.functions.names import col
from tallymark.sources.scratch import stash

#: Buckets of the first pass, and of the second over all unequal buckets of the first.
COARSE = 1 << 12
FINE = 1 << 16
#: Share of unequal fine buckets from which all rows are compared without a second pass.
DENSE = 0.9

_COARSE, _FINE = "_tm_coarse", "_tm_fine"


@dataclass(frozen=True)
class Digest:
    """Rows of each side, and the fine buckets (at most ``FINE`` rows) that hold all differences: None if there are none,
    or if nearly all buckets differ, so that the ``whole`` tables are in question."""

    source_rows: int
    target_rows: int
    unequal: DataFrame | None
    coarse_unequal: int
    parts: int
    whole: bool = False

    def rows_in_question(self, side: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows of a side that lie in unequal buckets. They are found where they are read."""
        if self.whole:
            return side
        if self.unequal is None:
            return side.limit(0)
        placed = side.withColumns({_COARSE: _coarse(keys), _FINE: _fine(keys, self.parts)})
        # the table has at most FINE rows
        return placed.join(F.broadcast(self.unequal), [_COARSE, _FINE], "left_semi").select(*[col(c) for c in side.columns])


def _coarse(keys: Sequence[str]) -> Column:
    return F.pmod(row_hash(keys), F.lit(COARSE).cast("bigint"))


def _fine(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.shiftrightunsigned(row_hash(keys), 12), F.lit(parts).cast("bigint"))


def _signed(side: DataFrame, buckets: Sequence[Column], keys: Sequence[str], columns: Sequence[str], sign: int) -> DataFrame:
    whole = row_hash([*keys, *columns])
    one = F.lit(1).cast("bigint")
    return side.select(
        *buckets,
        (whole.bitwiseAND(F.lit(0xFFFFFFFF)) * sign).alias("low"),
        (F.shiftrightunsigned(whole, 32) * sign).alias("high"),
        F.when(_fine(keys, max(1, FINE // COARSE)) == 0, whole.bitwiseAND(F.lit(0xFFFFFFFF)) * sign).otherwise(0).alias("probe"),
        F.xxhash64(F.lit("second"), *[p for c in [*keys, *columns] for p in (col(c), col(c).isNull())]).alias("second"),
        (one if sign > 0 else one * 0).alias("in_src"),
        (one * 0 if sign > 0 else one).alias("in_tgt"),
    )


def _digests(source: DataFrame, target: DataFrame, buckets: dict[str, Column], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    named = [c.alias(n) for n, c in buckets.items()]
    both = _signed(source, named, keys, columns, 1).unionByName(_signed(target, named, keys, columns, -1))
    # halves are summed apart, so that no sum of 64-bit numbers overflows
    summed = both.groupBy(*buckets).agg(
        F.sum("low").alias("low"), F.sum("high").alias("high"), F.sum("probe").alias("probe"), F.bit_xor("second").alias("second"),
        F.sum("in_src").alias("src_rows"), F.sum("in_tgt").alias("tgt_rows"),
    )
    equal = (col("low") == 0) & (col("high") == 0) & (col("second") == 0) & (col("src_rows") == col("tgt_rows"))
    return summed.select(*buckets, "src_rows", "tgt_rows", "probe", (~equal).alias("unequal"))


def compare_digests(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> Digest:
    """Compare two tables of the same columns bucket by bucket, in one pass if they are equal or differ nearly
    everywhere, else in two."""
    rows = _digests(source, target, {_COARSE: _coarse(keys)}, keys, columns).collect()
    totals = sum(r["src_rows"] for r in rows), sum(r["tgt_rows"] for r in rows)
    unequal = [(r[_COARSE],) for r in rows if r["unequal"]]
    if not unequal:
        return Digest(*totals, None, 0, 0)
    if sum(r["probe"] != 0 for r in rows) >= DENSE * COARSE:
        return Digest(*totals, None, len(unequal), 0, whole=True)
    parts = max(1, FINE // len(unequal))
    # at most COARSE rows
    chosen = F.broadcast(source.sparkSession.createDataFrame(unequal, f"{_COARSE} bigint"))
    left, right = (
        side.withColumn(_COARSE, _coarse(keys)).join(chosen, _COARSE, "left_semi") for side in (source, target)
    )
    fine = _digests(left, right, {_COARSE: col(_COARSE), _FINE: _fine(keys, parts)}, keys, columns)
    return Digest(*totals, stash(fine.filter("unequal").select(_COARSE, _FINE), "digest"), len(unequal), parts)
