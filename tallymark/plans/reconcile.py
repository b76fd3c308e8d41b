"""Compare a source table with a target table on their keys.

Four methods give the same result:

``hash``
    Keys and a row hash of both sides are stacked and grouped by key: one
    narrow shuffle, no join, and a key that repeats is folded before it moves.
    Only the keys that differ are then looked up in the full tables.
``full``
    One null-safe full outer join over all compared columns. No hash at all.
``anti``
    Two anti joins find missing and extra keys, an inner join the rest.
``digest``
    Sums of row hashes by key bucket tell which buckets can differ; only their
    rows are compared as ``hash`` does. Equal tables move no row at all.

Each method first writes its *outcome* to a scratch table: one row per record
that differs. It is as large as the differences are, and the difference rows
come from it. All rows are counted by status as they pass on the way there, so
one job gives counts and outcome.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType, TimestampNTZType

from tallymark.functions.canonical import (
    canonical_text,
    comparable,
    comparison_scales,
    comparison_text,
    dates_facing_timestamps,
    key_text,
    row_hash,
)
from tallymark.functions.casts import safe_cast
from tallymark.functions.names import col, find, lower_names
from tallymark.operators.joins import null_safe_join
from tallymark.operators.keys import FEW_KEYS, keys_in, keys_not_in
from tallymark.operators.rownumber import HOT_KEY_ROWS, number_cold_keys, number_within_keys
from tallymark.operators.skipping import KeyBounds, bound_columns, read_bounds, skip_to
from tallymark.plans.digest import compare_digests
from tallymark.plans.pairing import ORDINAL, PAIRED, SIDE, Surplus, paired_rows
from tallymark.sources.files import DIFF_COLUMNS, DIFF_SCHEMA
from tallymark.sources.scratch import release, stash
from tallymark.sources.servers import SERVER_COLUMN

METHODS = ("hash", "full", "anti", "digest")

# Difference types, and the texts that stand for a whole row.
MISSING = "MISSING_IN_TARGET"
EXTRA = "EXTRA_IN_TARGET"
MISMATCH = "VALUE_MISMATCH"
ENTIRE_ROW = "<ENTIRE_ROW>"
MISSING_EXPECTED = "<PRESENT_IN_SOURCE>"
MISSING_ACTUAL = "<MISSING_IN_TARGET>"
EXTRA_EXPECTED = "<EXTRA_IN_TARGET>"
EXTRA_ACTUAL = "<PRESENT_IN_TARGET>"
UNKNOWN_SERVER = "UNKNOWN"
NO_SERVER = "N/A"

# Columns that are never compared unless asked for.
DEFAULT_EXCLUDED = ("load_ts", "batch_id")

MATCH = "MATCH"
DUPLICATE = "DUPLICATE_KEY"

_ORDINAL = ORDINAL
_STATUS = "_tm_status"
_CELLS = "_tm_cells"
_SERVER = "_tm_server"
_CELLS_TYPE = "array<struct<column_name:string,expected_value:string,actual_value:string>>"


class DuplicateKeys(ValueError):
    """Keys that are not unique, so that rows cannot be paired."""


@dataclass(frozen=True)
class ReconCounts:
    """Row counts of one comparison. ``diff_rows`` counts records that differ, not cells."""

    source_rows: int
    target_rows: int
    matched_rows: int
    missing_rows: int
    extra_rows: int
    mismatched_rows: int

    @property
    def diff_rows(self) -> int:
        return self.missing_rows + self.extra_rows + self.mismatched_rows

    def as_dict(self) -> dict[str, int]:
        return {**asdict(self), "diff_rows": self.diff_rows}


COUNT_COLUMNS = (
    "source_rows",
    "target_rows",
    "matched_rows",
    "missing_rows",
    "extra_rows",
    "mismatched_rows",
    "diff_rows",
)


@dataclass(frozen=True)
class Sides:
    """Both tables as comparable values."""

    source: DataFrame
    target: DataFrame
    keys: list[str]
    columns: list[str]
    scales: Mapping[str, int]
    has_server: bool

    @property
    def pairing(self) -> list[str]:
        """The columns that pair rows: the keys, and the ordinal where keys repeat."""
        return self.keys + ([_ORDINAL] if _ORDINAL in self.source.columns else [])

    def text(self, name: str, prefix: str = "") -> Column:
        """Canonical text of a compared column, which a join may have prefixed."""
        return comparison_text(col(prefix + name), self.source.schema[name].dataType, self.scales.get(name))

    def key_text(self, prefix: str = "") -> Column:
        return key_text([self.text(k, prefix) for k in self.keys])


@dataclass(frozen=True)
class ReconResult:
    """The outcome of a comparison: one row per differing key. ``diff`` is written when first asked for."""

    sides: Sides
    method: str
    counts: ReconCounts
    outcome: DataFrame
    snapshot: bool = False
    bounds: Sequence[KeyBounds] = ()

    @property
    def passed(self) -> bool:
        return self.counts.diff_rows == 0

    @cached_property
    def diff(self) -> DataFrame:
        """One row per missing or extra record and per differing cell, as a scratch table: every reader sees the same
        rows, and the tables are not read again."""
        return empty_diff(self.outcome.sparkSession) if self.passed else stash(self.diff_plan(), "diff")

    def release(self) -> None:
        """Delete the scratch tables of this comparison; ``outcome`` and ``diff`` cannot be read afterwards."""
        written = [self.__dict__["diff"]] if "diff" in self.__dict__ else []
        copies = [self.sides.source, self.sides.target] if self.snapshot else []
        for table in (self.outcome, *written, *copies):
            release(table)

    def diff_plan(self) -> DataFrame:
        """The plan of ``diff``. Building it runs no job, and it depends on the number of rows that differ only in that
        more than ``FEW_KEYS`` of them are never broadcast."""
        if self.passed:
            return empty_diff(self.outcome.sparkSession)
        if _CELLS not in self.outcome.columns:
            return _hash_diff(self.sides, self.outcome, self.counts, self.bounds)
        return _explode_cells(self.sides, self.outcome)

    def counts_frame(self) -> DataFrame:
        schema = StructType([StructField(n, LongType(), False) for n in COUNT_COLUMNS])
        values = self.counts.as_dict()
        return self.outcome.sparkSession.createDataFrame([tuple(values[n] for n in COUNT_COLUMNS)], schema)


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = DEFAULT_EXCLUDED,
    method: str = "hash",
    on_duplicate: str = "error",
    temporal: str = "text",
    force_types: Mapping[str, str] | None = None,
    snapshot: bool = False,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> ReconResult:
    """Compare ``source`` (expected) with ``target`` (actual) on ``keys``.

    ``columns``: what to compare; by default all common columns but the keys
    and ``exclude``. Names match in any case. NULL equals NULL, also in a key;
    it equals neither ``'null'`` nor ``''``.

    ``on_duplicate``: ``error`` raises :class:`DuplicateKeys` if a key repeats on
    either side (method ``digest`` does not look into buckets whose rows are the
    same on both sides); ``ordinal`` pairs repeated keys by their order, taken
    over all compared columns; ``cancel`` (methods ``hash`` and ``digest``)
    matches equal rows first, however they are ordered, and pairs what is left
    under a key so that the fewest cells differ, or by order past
    ``pairing.ASSIGN_ROWS`` rows of one key.

    ``temporal``: ``text`` keeps a date and a timestamp apart, ``promote``
    compares them as timestamps. ``force_types`` casts columns of both sides first
    and compares their text; a value that cannot be cast is compared as it is.

    ``snapshot`` writes both sides to scratch tables first. Use it where reading
    twice is dear or might give different rows: a live database, a long mapping.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    sides = prepare(source, target, keys, columns, exclude, temporal, force_types)
    if snapshot:
        sides = replace(sides, source=stash(sides.source, "source"), target=stash(sides.target, "target"))
    if on_duplicate == "cancel" and method not in ("hash", "digest"):
        raise ValueError(f"on_duplicate='cancel' goes with method 'hash' or 'digest', not {method!r}")
    if on_duplicate == "cancel":
        return _cancelled(sides, method, snapshot, hot_key_rows)
    stacked = on_duplicate == "ordinal" and method == "hash" and _widest_key(sides) <= hot_key_rows
    if not stacked:
        sides = _settle_duplicates(sides, on_duplicate, check=method in ("full", "anti"), hot_key_rows=hot_key_rows)
    asked, digest = sides, None
    if method == "digest":
        digest = compare_digests(sides.source, sides.target, sides.pairing, sides.columns)
        asked = _in_question(sides, digest)
    outcome_of = {"hash": _hash_outcome, "digest": _hash_outcome, "full": _full_outcome, "anti": _anti_outcome}[method]
    if on_duplicate == "ordinal" and method == "hash":
        # numbering has moved the full rows by key already: their cells are compared there, not looked up again
        outcome_of = _stacked_outcome if stacked else _full_outcome
    rows = outcome_of(asked)
    outcome, found = _written(rows, sides.pairing)
    counts = _counts(sides, found)
    if digest is not None:
        counts = replace(
            counts, source_rows=digest.source_rows, target_rows=digest.target_rows,
            matched_rows=digest.source_rows - counts.missing_rows - counts.mismatched_rows,
        )
    return ReconResult(sides, method, counts, outcome, snapshot, read_bounds(found, sides.pairing))


def _in_question(sides: Sides, digest) -> Sides:
    source, target = (digest.rows_in_question(s, sides.pairing) for s in (sides.source, sides.target))
    return replace(sides, source=source, target=target)


def _written(rows: DataFrame, pairing: Sequence[str]) -> tuple[DataFrame, dict]:
    """The outcome of rows with a status, the number of rows of each status, and the bounds of keys to look up."""
    counted = Observation("counts")
    # counted while the rows are written, in the stage that follows the comparison's own shuffle
    statuses = (MATCH, MISSING, EXTRA, MISMATCH, DUPLICATE)
    sought = col(_STATUS).isin(MISSING, MISMATCH)
    observed = rows.observe(
        counted, *[F.count_if(col(_STATUS) == s).alias(s) for s in statuses], *bound_columns(rows, pairing, sought)
    )
    outcome = stash(observed.filter(~col(_STATUS).isin(MATCH, DUPLICATE)), "outcome")
    return outcome, counted.get


def _cancelled(sides: Sides, method: str, snapshot: bool, hot_key_rows: int) -> ReconResult:
    """Equal rows cancel; the rest is paired within its key. The outcome holds the cells, as that of ``full`` does."""
    asked, digest = sides, None
    if method == "digest":
        digest = compare_digests(sides.source, sides.target, sides.keys, sides.columns)
        asked = _in_question(sides, digest)
    surplus = Surplus(asked.source, asked.target, sides.keys, sides.columns)
    rows = paired_rows(surplus, asked.source, asked.target, hot_key_rows)
    own = [SERVER_COLUMN, *sides.keys, *sides.columns]
    paired = rows.filter(PAIRED)
    left, right = (paired.filter(col(SIDE) == s).select(*[col(c) for c in own], ORDINAL) for s in (0, 1))
    named = replace(sides, source=left, target=right, has_server=sides.has_server)
    both = null_safe_join(left, right.drop(SERVER_COLUMN), named.pairing, "inner", surplus.rows <= FEW_KEYS)
    lone = rows.filter(~col(PAIRED))
    server = _server(SERVER_COLUMN, sides.has_server)
    plain = replace(sides, source=sides.source.drop(ORDINAL))
    missing = (
        surplus.rows_of(asked.source, 1, ~surplus.contested).select(*[col(c) for c in [SERVER_COLUMN, *sides.keys]])
        if sides.has_server else surplus.alone(1)
    )
    parts = [
        _statuses(both, sides, F.lit(MISMATCH), {k: col(f"src_{k}") for k in sides.keys}),
        _lone_rows(lone.filter(col(SIDE) == 0), plain, MISSING, server),
        _lone_rows(lone.filter(col(SIDE) == 1), plain, EXTRA, F.lit(NO_SERVER)),
        _lone_rows(missing, plain, MISSING, server),
        _lone_rows(surplus.alone(-1), plain, EXTRA, F.lit(NO_SERVER)),
    ]
    outcome, found = _written(reduce(DataFrame.unionByName, parts), [])
    totals = digest or surplus
    missing_rows, extra_rows, mismatched = (found[s] for s in (MISSING, EXTRA, MISMATCH))
    matched = totals.source_rows - missing_rows - mismatched
    counts = ReconCounts(totals.source_rows, totals.target_rows, matched, missing_rows, extra_rows, mismatched)
    return ReconResult(sides, method, counts, outcome, snapshot)


def recon_counts(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = DEFAULT_EXCLUDED,
) -> DataFrame:
    """The counts alone as a lazy one-row DataFrame: one narrow shuffle, one pass.

    Keys are taken to be unique; a ``duplicate_keys`` above 0 says that they were not.
    """
    sides = prepare(source, target, keys, columns, exclude)
    pairs = slim_pairs(sides)
    status = _slim_status()
    count = F.count_if
    return pairs.agg(
        F.coalesce(F.sum("src_rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("tgt_rows"), F.lit(0)).alias("target_rows"),
        count(status == MATCH).alias("matched_rows"),
        count(status == MISSING).alias("missing_rows"),
        count(status == EXTRA).alias("extra_rows"),
        count(status == MISMATCH).alias("mismatched_rows"),
        count(status.isin(MISSING, EXTRA, MISMATCH)).alias("diff_rows"),
        count(status == DUPLICATE).alias("duplicate_keys"),
    )


# -- preparation ------------------------------------------------------------------


def prepare(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    temporal: str = "text",
    force_types: Mapping[str, str] | None = None,
) -> Sides:
    """Lower-case names, choose the columns, and make both sides comparable."""
    if temporal not in ("text", "promote"):
        raise ValueError(f"temporal must be 'text' or 'promote', not {temporal!r}")
    source, target = lower_names(source), lower_names(target)
    keys = [k.lower() for k in keys]
    if not keys:
        raise ValueError("a comparison needs at least one key column")
    if columns is None:
        columns = common_columns(source, target, keys, exclude)
    columns = [c.lower() for c in columns]
    for c in [*keys, *columns]:
        find(source.columns, c, "source")
        find(target.columns, c, "target")
    forced = {c.lower(): t for c, t in (force_types or {}).items()}
    source, target = _force(source, forced), _force(target, forced)
    named = [*keys, *columns]
    if temporal == "promote":
        promoted = {c: TimestampNTZType() for c in dates_facing_timestamps(source.schema, target.schema, named)}
        source, target = _cast(source, promoted), _cast(target, promoted)
    scales = comparison_scales(source.schema, target.schema, named)
    has_server = SERVER_COLUMN in source.columns
    values = _comparables(source.schema, target.schema, named, scales)
    server = [col(SERVER_COLUMN).cast("string")] if has_server else []
    other = _comparables(target.schema, source.schema, named, scales)
    return Sides(source.select(*server, *values), target.select(*other), keys, columns, scales, has_server)


def _comparables(own: StructType, other: StructType, names: Sequence[str], scales: Mapping[str, int]) -> list[Column]:
    return [comparable(col(c), own[c].dataType, other[c].dataType, scales.get(c)).alias(c) for c in names]


def common_columns(source: DataFrame, target: DataFrame, keys: Iterable[str], exclude: Iterable[str] = ()) -> list[str]:
    """Columns of both tables but the keys, the excluded and the server tag, in any case, sorted."""
    left_out = {c.lower() for c in [*keys, *exclude, SERVER_COLUMN]}
    return sorted({c.lower() for c in source.columns} & {c.lower() for c in target.columns} - left_out)


def _force(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns as the text of a forced type. A value that cannot be cast keeps its own text, so that it can never equal
    another by becoming NULL."""
    chosen = {}
    for name, wanted in types.items():
        if name in df.columns:
            kind = DataType.fromDDL(wanted) if isinstance(wanted, str) else wanted
            text = canonical_text(safe_cast(col(name), kind), kind, None)
            chosen[name] = F.coalesce(text, F.trim(col(name).cast("string")))
    return df.withColumns(chosen) if chosen else df


def _cast(df: DataFrame, types: Mapping) -> DataFrame:
    chosen = {c: safe_cast(col(c), t) for c, t in types.items() if c in df.columns}
    return df.withColumns(chosen) if chosen else df


def _widest_key(sides: Sides) -> int:
    """The most rows that one key has on either side."""
    pairs = slim_pairs(replace(sides, columns=[]))
    return pairs.agg(F.max(F.greatest("src_rows", "tgt_rows"))).first()[0] or 0


def _settle_duplicates(sides: Sides, on_duplicate: str, check: bool, hot_key_rows: int) -> Sides:
    if on_duplicate == "error":
        # the hash method sees repeated keys in its own pass
        if check:
            pairs = slim_pairs(replace(sides, columns=[]))
            _refuse(pairs.filter(_slim_status() == DUPLICATE).agg(F.count(F.lit(1))).first()[0], sides.keys)
        return sides
    if on_duplicate != "ordinal":
        raise ValueError(f"on_duplicate must be 'error', 'ordinal' or 'cancel', not {on_duplicate!r}")
    # keys that occur once on either side need no number; equal rows of two servers are ordered by server
    pairs = slim_pairs(replace(sides, columns=[]))
    most = F.greatest("src_rows", "tgt_rows")
    widest = Observation("widest")
    repeated = stash(
        pairs.filter(most > 1).observe(widest, F.max(most).alias("most"), F.count(F.lit(1)).alias("keys")).select(*[col(k) for k in sides.keys]),
        "repeated-keys",
    )
    hot = (widest.get["most"] or 0) > hot_key_rows
    few = (widest.get["keys"] or 0) <= FEW_KEYS

    def numbered(side: DataFrame) -> DataFrame:
        order = [*sides.columns, *([SERVER_COLUMN] if SERVER_COLUMN in side.columns else [])]
        once = keys_not_in(side, repeated, sides.keys, few).withColumn(_ORDINAL, F.lit(1).cast("bigint"))
        again = keys_in(side, repeated, sides.keys, few)
        again = (
            number_within_keys(again, sides.keys, order, _ORDINAL, hot_key_rows)
            if hot else number_cold_keys(again, sides.keys, order, _ORDINAL)
        )
        return once.unionByName(again.withColumn(_ORDINAL, col(_ORDINAL).cast("bigint")))

    return replace(sides, source=numbered(sides.source), target=numbered(sides.target))


def _refuse(duplicates: int, keys: Sequence[str]) -> None:
    if duplicates:
        raise DuplicateKeys(
            f"{duplicates} key(s) over {list(keys)} occur more than once; "
            "list them with key_uniqueness, or pass on_duplicate='ordinal'"
        )


# -- hash -------------------------------------------------------------------------


def slim_pairs(sides: Sides) -> DataFrame:
    """Key by key: the rows on each side, and the exclusive or of their row hashes.

    It tells what a full outer join of both sides on key and hash would, but by
    grouping: NULL keys meet by themselves, and repeats are folded map-side. One
    row on each side with equal hashes gives a ``hash_xor`` of 0.
    """
    hashed = row_hash(sides.columns).alias("hash")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    keys = [col(k) for k in sides.pairing]
    source = sides.source.select(*keys, hashed, one.alias("in_src"), none.alias("in_tgt"))
    target = sides.target.select(*keys, hashed, none.alias("in_src"), one.alias("in_tgt"))
    return source.unionByName(target).groupBy(*keys).agg(
        F.sum("in_src").alias("src_rows"),
        F.sum("in_tgt").alias("tgt_rows"),
        F.bit_xor("hash").alias("hash_xor"),
    )


def _slim_status() -> Column:
    return (
        F.when((col("src_rows") > 1) | (col("tgt_rows") > 1), DUPLICATE)
        .when(col("tgt_rows") == 0, MISSING)
        .when(col("src_rows") == 0, EXTRA)
        .when(col("hash_xor") != 0, MISMATCH)
        .otherwise(MATCH)
    )


def _hash_outcome(sides: Sides) -> DataFrame:
    return slim_pairs(sides).select(_slim_status().alias(_STATUS), *[col(k) for k in sides.pairing])


def _hash_diff(sides: Sides, outcome: DataFrame, counts: ReconCounts, bounds: Sequence[KeyBounds]) -> DataFrame:
    """Look the differing keys up in the full tables. Their bounds reach the scans and a Bloom filter tests what these
    return, before anything is shuffled. A small outcome is broadcast: it is a scratch table, so the planner knows its
    size."""
    pairing = sides.pairing

    def looked_up(side: DataFrame, wanted: DataFrame, count: int) -> DataFrame:
        return keys_in(skip_to(side, wanted, pairing, bounds, count), wanted, pairing, count <= FEW_KEYS)

    parts = []
    if counts.extra_rows:
        extra = outcome.filter(col(_STATUS) == EXTRA)
        parts.append(_whole_row(extra, EXTRA, sides.key_text(), F.lit(NO_SERVER)))
    if counts.missing_rows and not sides.has_server:
        missing = outcome.filter(col(_STATUS) == MISSING)
        parts.append(_whole_row(missing, MISSING, sides.key_text(), F.lit(UNKNOWN_SERVER)))
    if counts.missing_rows and sides.has_server:
        tagged = sides.source.select(*[col(k) for k in pairing], col(SERVER_COLUMN))
        missing = looked_up(tagged, outcome.filter(col(_STATUS) == MISSING), counts.missing_rows)
        parts.append(_whole_row(missing, MISSING, sides.key_text(), _server(SERVER_COLUMN, True)))
    if counts.mismatched_rows:
        changed = outcome.filter(col(_STATUS) == MISMATCH).select(*[col(k) for k in pairing])
        source, target = (looked_up(side, changed, counts.mismatched_rows) for side in (sides.source, sides.target))
        parts.append(cell_diff(null_safe_join(source, target, pairing, "inner", counts.mismatched_rows <= FEW_KEYS), sides))
    return reduce(DataFrame.unionByName, parts)


# -- full and anti ------------------------------------------------------------------


def _full_outcome(sides: Sides) -> DataFrame:
    present = F.lit(True).alias("_tm_here")
    joined = null_safe_join(
        sides.source.select("*", present), sides.target.select("*", present), sides.pairing, "full"
    )
    in_source, in_target = col("src__tm_here").isNotNull(), col("tgt__tm_here").isNotNull()
    status = (
        F.when(~in_target, MISSING)
        .when(~in_source, EXTRA)
        .when(_any_differs(sides.columns), MISMATCH)
        .otherwise(MATCH)
    )
    keys = {k: F.when(in_source, col(f"src_{k}")).otherwise(col(f"tgt_{k}")) for k in sides.pairing}
    return _statuses(joined, sides, status, keys)


def _stacked_outcome(sides: Sides) -> DataFrame:
    """Repeated keys paired by order, where no key is hot: both sides are stacked and move once, by key. There rows are
    numbered within key and side, and those of one number meet by grouping."""
    tag = F.lit(None).cast("string").alias(SERVER_COLUMN)
    values = [*sides.columns, SERVER_COLUMN]

    def stacked(side: DataFrame, number: int) -> DataFrame:
        rows = side if SERVER_COLUMN in side.columns else side.select("*", tag)
        return rows.select(*[col(c) for c in [*sides.keys, *values]], F.lit(number).alias(SIDE))

    rows = stacked(sides.source, 0).unionByName(stacked(sides.target, 1)).repartition(*[col(k) for k in sides.keys])
    numbered = number_cold_keys(rows, [*sides.keys, SIDE], values, _ORDINAL)
    pairing = [*sides.keys, _ORDINAL]
    # the tag makes a struct of no compared columns one field wide
    held = F.struct(*[col(c) for c in values])
    met = numbered.groupBy(*[col(c) for c in pairing]).agg(*[
        F.first(F.when(col(SIDE) == number, held), ignorenulls=True).alias(name) for number, name in enumerate(("_tm_src", "_tm_tgt"))
    ])
    joined = met.select(
        *[col(k).alias(f"src_{k}") for k in pairing],
        *[col(f"_tm_{side}").getField(c).alias(f"{side}_{c}") for side in ("src", "tgt") for c in values],
        col("_tm_src").isNotNull().alias("_tm_in_src"), col("_tm_tgt").isNotNull().alias("_tm_in_tgt"),
    )
    status = (
        F.when(~col("_tm_in_tgt"), MISSING)
        .when(~col("_tm_in_src"), EXTRA)
        .when(_any_differs(sides.columns), MISMATCH)
        .otherwise(MATCH)
    )
    return _statuses(joined, sides, status, {k: col(f"src_{k}") for k in pairing})


def _anti_outcome(sides: Sides) -> DataFrame:
    both = null_safe_join(sides.source, sides.target, sides.pairing, "inner")
    status = F.when(_any_differs(sides.columns), MISMATCH).otherwise(MATCH)
    paired = _statuses(both, sides, status, {k: col(f"src_{k}") for k in sides.pairing})
    missing = keys_not_in(sides.source, sides.target, sides.pairing)
    extra = keys_not_in(sides.target, sides.source, sides.pairing)
    return (
        paired.unionByName(_lone_rows(missing, sides, MISSING, _server(SERVER_COLUMN, sides.has_server)))
        .unionByName(_lone_rows(extra, sides, EXTRA, F.lit(NO_SERVER)))
    )


def _lone_rows(rows: DataFrame, sides: Sides, status: str, server: Column) -> DataFrame:
    return rows.select(
        F.lit(status).alias(_STATUS),
        *[col(k) for k in sides.pairing],
        server.alias(_SERVER),
        F.lit(None).cast(_CELLS_TYPE).alias(_CELLS),
    )


def _statuses(joined: DataFrame, sides: Sides, status: Column, keys: Mapping[str, Column]) -> DataFrame:
    """The status of each pair of rows with its key, its server and its differing cells."""
    rows = joined.withColumn(_STATUS, status)
    return rows.select(
        _STATUS,
        *[c.alias(k) for k, c in keys.items()],
        F.when(col(_STATUS) == EXTRA, NO_SERVER).otherwise(_joined_server(sides.has_server)).alias(_SERVER),
        F.when(col(_STATUS) == MISMATCH, _differing_cells(sides)).alias(_CELLS),
    )


def _explode_cells(sides: Sides, outcome: DataFrame) -> DataFrame:
    cells = outcome.filter(col(_STATUS) == MISMATCH).select(
        sides.key_text().alias("primary_key_value"), col(_SERVER).alias("source_server"),
        F.explode(_CELLS).alias("cell"),
    )
    parts = [_whole_row(outcome.filter(col(_STATUS) == s), s, sides.key_text(), col(_SERVER)) for s in (MISSING, EXTRA)]
    return reduce(DataFrame.unionByName, [*parts, _cell_rows(cells)])


# -- shared -----------------------------------------------------------------------


def cell_diff(joined: DataFrame, sides: Sides) -> DataFrame:
    """One row per differing cell of rows joined as ``src_…`` and ``tgt_…``."""
    return _cell_rows(joined.select(
        sides.key_text("src_").alias("primary_key_value"),
        _joined_server(sides.has_server).alias("source_server"),
        F.explode(_differing_cells(sides)).alias("cell"),
    ))


def _cell_rows(exploded: DataFrame) -> DataFrame:
    return exploded.select(
        "primary_key_value", "source_server", "cell.column_name", "cell.expected_value", "cell.actual_value",
        F.lit(MISMATCH).alias("diff_type"),
    )


def _differing_cells(sides: Sides) -> Column:
    if not sides.columns:
        return F.array().cast(_CELLS_TYPE)
    cells = F.array(*[
        F.when(
            _differs(c),
            F.struct(
                F.lit(c).alias("column_name"),
                sides.text(c, "src_").alias("expected_value"),
                sides.text(c, "tgt_").alias("actual_value"),
            ),
        )
        for c in sides.columns
    ])
    return F.array_compact(cells).cast(_CELLS_TYPE)


def _differs(c: str) -> Column:
    return ~col(f"src_{c}").eqNullSafe(col(f"tgt_{c}"))


def _any_differs(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [_differs(c) for c in columns], F.lit(False))


def _joined_server(has_server: bool) -> Column:
    return _server(f"src_{SERVER_COLUMN}", has_server)


def _server(name: str, has_server: bool) -> Column:
    if not has_server:
        return F.lit(UNKNOWN_SERVER)
    return F.coalesce(F.nullif(col(name), F.lit("")), F.lit(UNKNOWN_SERVER))


def _whole_row(rows: DataFrame, diff_type: str, text: Column, server: Column) -> DataFrame:
    expected, actual = (
        (MISSING_EXPECTED, MISSING_ACTUAL) if diff_type == MISSING else (EXTRA_EXPECTED, EXTRA_ACTUAL)
    )
    return rows.select(
        text.alias("primary_key_value"), server.alias("source_server"), F.lit(ENTIRE_ROW).alias("column_name"),
        F.lit(expected).alias("expected_value"), F.lit(actual).alias("actual_value"),
        F.lit(diff_type).alias("diff_type"),
    )


def _counts(sides: Sides, per_status: Mapping[str, int]) -> ReconCounts:
    _refuse(per_status[DUPLICATE], sides.keys)
    matched, missing, extra, mismatched = (per_status[s] for s in (MATCH, MISSING, EXTRA, MISMATCH))
    both = matched + mismatched
    return ReconCounts(both + missing, both + extra, matched, missing, extra, mismatched)


def empty_diff(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIFF_SCHEMA)


def check_diff_columns(diff: DataFrame) -> None:
    """A difference table must carry all six columns."""
    absent = sorted(set(DIFF_COLUMNS) - set(diff.columns))
    if absent:
        raise ValueError(f"difference table lacks {absent}; it has {sorted(diff.columns)}")
