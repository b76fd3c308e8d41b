"""Leave out rows that a set of keys cannot name, before anything is shuffled.

Two tests, the same at every size, neither of which loses a row: ranges of the
key set become filters that reach the scan, and a Bloom filter of bounded size
tests what the scan returns. What passes both may still be wrong; the caller's
semi join decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.canonical import row_hash
from tallymark.functions.names import col

#: 64-bit words of the Bloom filter, least and most. 2 ** 18 rows of two numbers are broadcast at the most.
WORDS = (1 << 6, 1 << 18)
#: Ranges that stand for the key set in the scan, for a whole-number key.
RANGES = 16

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ORDERED = (*_INTEGRAL, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
_WORD, _BITS = "_tm_word", "_tm_bits"


@dataclass(frozen=True)
class KeyBounds:
    """Least and greatest value of one key column over a key set, and whether it holds NULL."""

    name: str
    least: object
    most: object
    has_null: bool


def bound_columns(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> list[Column]:
    """Aggregates that :func:`read_bounds` understands, of the rows that ``where`` chooses."""
    out = []
    for i, k in enumerate(keys):
        if isinstance(df.schema[k].dataType, _ORDERED):
            value = col(k) if where is None else F.when(where, col(k))
            null = col(k).isNull() if where is None else where & col(k).isNull()
            out += [F.min(value).alias(f"least_{i}"), F.max(value).alias(f"most_{i}"), F.count_if(null).alias(f"nulls_{i}")]
    return out


def read_bounds(row: dict, keys: Sequence[str]) -> list[KeyBounds]:
    return [
        KeyBounds(k, row[f"least_{i}"], row[f"most_{i}"], bool(row[f"nulls_{i}"]))
        for i, k in enumerate(keys)
        if f"least_{i}" in row
    ]


def within_bounds(df: DataFrame, bounds: Sequence[KeyBounds]) -> DataFrame:
    """Rows whose key columns lie in the bounds; a NULL key stays only where the key set holds one."""
    for b in bounds:
        key = col(b.name)
        if b.least is None:
            df = df.filter(key.isNull()) if b.has_null else df
            continue
        kind = df.schema[b.name].dataType
        inside = (key >= F.lit(b.least).cast(kind)) & (key <= F.lit(b.most).cast(kind))
        df = df.filter(inside | key.isNull() if b.has_null else inside)
    return df


def word_count(keys: int) -> int:
    """Words for a number of keys: eight bits a key, a power of two, within bounds."""
    least, most = WORDS
    return min(most, max(least, 1 << max(0, (keys * 8 // 64)).bit_length()))


def _mask(keys: Sequence[str]) -> Column:
    """Three bits of a word, chosen by a second hash of the key."""
    spread = F.xxhash64(F.lit("bits"), row_hash(keys))
    places = [F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(3)]
    # shiftleft() of the functions module takes whole numbers only
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
    return reduce(Column.bitwiseOR, bits)


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(row_hash(keys), F.lit(words).cast("bigint"))


def bloom_words(key_table: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """The Bloom filter of a key table: at most ``words`` rows, folded before they move."""
    return key_table.groupBy(_word(keys, words).alias(_WORD)).agg(F.bit_or(_mask(keys)).alias(_BITS))


def may_be_in(df: DataFrame, words_table: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """Rows whose key the Bloom filter may hold."""
    # no more than ``words`` rows, whatever the key set's size
    joined = df.join(F.broadcast(words_table), _word(keys, words) == col(_WORD))
    return joined.filter(col(_BITS).bitwiseAND(_mask(keys)) == _mask(keys)).select(*[df[f"`{c}`"] for c in df.columns])


def skip_to(df: DataFrame, key_table: DataFrame, keys: Sequence[str], bounds: Sequence[KeyBounds], count: int) -> DataFrame:
    """Rows that ``key_table`` (same key names, about ``count`` keys) may name, NULL meeting NULL.

    Key columns whose types differ, or whose equal values may have unequal
    hashes (0.0 and -0.0), are left out of both tests.
    """
    usable = [k for k in keys if isinstance(kind := df.schema[k].dataType, _ORDERED) and kind == key_table.schema[k].dataType]
    if not usable:
        return df
    words = word_count(count)
    near = within_bounds(df, [b for b in bounds if b.name in usable])
    return may_be_in(near, bloom_words(key_table, usable, words), usable, words)


def key_set_bounds(key_table: DataFrame, keys: Sequence[str]) -> tuple[list[KeyBounds], int]:
    """Bounds and size of a key set, by one aggregate over it."""
    row = key_table.agg(*bound_columns(key_table, keys), F.count(F.lit(1)).alias("n")).first().asDict()
    return read_bounds(row, keys), row["n"]


def range_filter(df: DataFrame, key_table: DataFrame, key: str, pieces: int = RANGES) -> Column | None:
    """A filter of up to ``pieces`` ranges that hold all values of a whole-number key, cut where its quantiles are.

    It keeps a scan from row groups that lie between clusters of keys. None for
    other types and for a key set without values.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, _INTEGRAL) or not isinstance(key_table.schema[key].dataType, _INTEGRAL):
        return None
    shares = [i / pieces for i in range(1, pieces)]
    cuts = key_table.agg(F.percentile_approx(col(key), shares).alias("cuts")).first()["cuts"]
    if not cuts:
        return None
    piece = reduce(lambda a, b: a + b, [F.when(col(key) > F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))])
    ends = key_table.filter(col(key).isNotNull()).groupBy(piece.alias("piece")).agg(F.min(col(key)).alias("lo"), F.max(col(key)).alias("hi"))
    ranges = [(col(key) >= F.lit(r["lo"]).cast(kind)) & (col(key) <= F.lit(r["hi"]).cast(kind)) for r in ends.collect()]
    return reduce(Column.__or__, ranges)
