"""Mixing sources to target weights, in DataFrame operations only.

Every row gets a key that looks random but depends on its id alone. The keys
range-partition each source into buckets of a few thousand rows; as the keys are uniform, the
buckets of one source are of like size, so a source that holds a third of all
rows is spread over many tasks. Bucket totals give each bucket's offset, a
window inside a bucket gives each row's offset, and a row is taken while its
offset lies below its source's budget. Budgets above a source's size repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.sources.scratch import stash

#: White space that separates words.
WORD = "[^\\x20\\x09-\\x0D]+"

#: Rows that a bucket may hold on average: one window sorts them with the columns they carry.
BUCKET_ROWS = 4096
_OWN = ("_mx_src", "_mx_key", "_mx_bucket", "_mx_size")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, repeat: int = 2
) -> DataFrame:
    """Add ``target`` to one row per source (``source`` key text and ``source_size``).

    Sources in the order of their key get the weights in turn, and share
    ``share`` times the total by weight; a target stops at ``repeat`` times its
    source's size, and what is above goes to the others by weight. The level at
    which that ends is found without a loop: with sources sorted by cap over
    weight, it is the level of the first source that stays below its cap. The
    windows go over one row per source.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    by_name = Window.orderBy("source")
    rows = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    )
    rows = rows.withColumn("cap", col("source_size") * F.lit(repeat))
    everything = Window.partitionBy()
    ratio = col("cap").cast("double") / col("weight")
    filling = Window.orderBy(ratio, "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onwards = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumns({
        "ratio": ratio,
        "level": (
            F.sum("source_size").over(everything) * F.lit(float(share))
            - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double")
        ) / F.sum("weight").over(onwards),
    })
    level = F.max(F.when(col("level") <= col("ratio"), col("level"))).over(everything)
    target = F.least(col("cap").cast("double"), F.coalesce(level * col("weight"), col("cap").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    repeat: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken``.

    ``taken`` is what the mix takes of a row: whole epochs of its source first,
    and in the last epoch the rows whose keys come first, the row at the cut in
    part. The taken sizes of a source add up to its target rounded down. NULL
    sources are a source of their own, last in order; a NULL id has a key too;
    rows of equal id are taken in the order of their size; rows of size 0 take
    nothing; an empty table gives an empty result. Columns of ``docs`` called
    like a result column are replaced.
    """
    # hex digits of the key that name a bucket: they follow the table, so that no bucket grows with it
    digits, rows = 1, docs.count()
    while rows > BUCKET_ROWS << (4 * digits):
        digits += 1
    key = F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(col(id_col).cast("string"), F.lit("")))), 1, 16)
    name = col(source_col).cast("string")
    keyed = docs.withColumns({
        "_mx_size": F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)),
        "_mx_src": F.when(name.isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), name)),
        "_mx_key": key,
        "_mx_bucket": F.substring(key, 1, digits),
    })
    # read twice below; one row per source and bucket
    buckets = stash(
        keyed.groupBy(col("_mx_src").alias("source"), col("_mx_bucket").alias("bucket")).agg(
            F.sum("_mx_size").alias("bucket_size")
        ),
        "mix-buckets",
    )
    targets = source_targets(
        buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, repeat
    )
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        "source", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset")
    )
    offsets = stash(offsets.join(targets, "source"), "mix-offsets").select(
        col("source").alias("_mx_s"), col("bucket").alias("_mx_b"),
        col("offset").alias("_mx_offset"), col("source_size").alias("_mx_total"), col("target").alias("_mx_target"),
    )
    placed = keyed.join(
        offsets, (col("_mx_src") == col("_mx_s")) & (col("_mx_bucket") == col("_mx_b"))
    )
    within = (
        Window.partitionBy("_mx_src", "_mx_bucket")
        .orderBy("_mx_key", col(id_col), "_mx_size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = col("_mx_offset") + F.coalesce(F.sum("_mx_size").over(within), F.lit(0))
    budget = F.floor(col("_mx_target"))
    epochs = F.when(col("_mx_total") > 0, F.floor(budget / col("_mx_total"))).otherwise(F.lit(0))
    placed = placed.withColumns({"_mx_start": start, "_mx_epochs": epochs})
    rest = budget - col("_mx_epochs") * col("_mx_total") - col("_mx_start")
    taken = col("_mx_epochs") * col("_mx_size") + F.greatest(F.lit(0), F.least(col("_mx_size"), rest))
    results = {
        "size": col("_mx_size"),
        "source_size": col("_mx_total"),
        "target": col("_mx_target"),
        "taken": taken.cast("bigint"),
    }
    kept = [c for c in docs.columns if c not in results]
    return placed.select(*[col(c) for c in kept], *[v.alias(k) for k, v in results.items()])
