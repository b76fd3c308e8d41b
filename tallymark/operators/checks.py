"""Data checks. Each is one aggregation over the rows; what it finds comes back as rows."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType, StringType, StructType

from tallymark.functions.casts import safe_cast
from tallymark.functions.names import col, find
from tallymark.functions.types import (
    agrees_with_spark,
    declared_type_to_spark,
    declared_value_type,
    spark_type_to_declared,
)
from tallymark.spec import DeclaredColumn


class NullsFound(ValueError):
    """NULLs in columns that must have none; ``counts`` says how many in each."""

    def __init__(self, counts: Mapping[str, int]):
        self.counts = dict(counts)
        super().__init__(f"NULL in required column(s): {self.counts}")


def null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its name and how many NULLs it holds."""
    names = [find(df.columns, c, "required column") for c in columns]
    counts = df.agg(*[F.count_if(col(n).isNull()).alias(f"n{i}") for i, n in enumerate(names)])
    return _rows(counts, [
        F.struct(F.lit(n).alias("column_name"), F.col(f"n{i}").alias("null_count")) for i, n in enumerate(names)
    ])


def require_no_nulls(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise :class:`NullsFound` with the counts if any of the columns holds a NULL."""
    found = null_check(df, columns).filter("null_count > 0").collect()
    if found:
        raise NullsFound({r["column_name"]: r["null_count"] for r in found})


def refuse_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; whatever reads one of the columns fails if it holds a NULL."""
    checked = {
        n: F.coalesce(col(n), F.raise_error(F.lit(f"NULL in required column {n}")).cast(df.schema[n].dataType))
        for n in (find(df.columns, c, "required column") for c in columns)
    }
    return df.withColumns(checked) if checked else df


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often. NULL counts as a value."""
    names = [find(df.columns, k, "key") for k in keys]
    return (
        df.groupBy(*[col(n) for n in names])
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def join_fanout(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """For each key of ``left``: its rows there, its rows in ``right``, and the rows a left join gives.

    Both sides are counted by key before they meet, so a key with very many
    rows is one row in the join.
    """
    pairs = [(find(left.columns, a, "left key"), find(right.columns, b, "right key")) for a, b in keys]
    lefts = left.groupBy(*[col(a) for a, _ in pairs]).agg(F.count(F.lit(1)).alias("left_rows"))
    rights = right.groupBy(*[col(b).alias(f"_tm_key_{i}") for i, (_, b) in enumerate(pairs)]).agg(
        F.count(F.lit(1)).alias("_tm_rows")
    )
    on = [lefts[f"`{a}`"] == rights[f"_tm_key_{i}"] for i, (a, _) in enumerate(pairs)]
    matched = F.coalesce(F.col("_tm_rows"), F.lit(0))
    return lefts.join(rights, on, "left").select(
        *[col(a) for a, _ in pairs],
        F.col("left_rows"),
        matched.alias("right_rows"),
        (F.col("left_rows") * F.greatest(matched, F.lit(1))).alias("joined_rows"),
    )


def fanout_summary(fanout: DataFrame) -> DataFrame:
    """One row: rows before and after the join, rows without a match, and the widest fan-out."""
    return fanout.agg(
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("joined_rows"), F.lit(0)).alias("joined_rows"),
        F.coalesce(F.sum(F.when(F.col("right_rows") == 0, F.col("left_rows"))), F.lit(0)).alias("unmatched_rows"),
        F.coalesce(F.max("right_rows"), F.lit(0)).alias("widest"),
    )


def row_count_check(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every stage, and whether it equals the first stage's."""
    counted = None
    for name, df in stages.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        counted = one if counted is None else counted.unionByName(one)
    names = list(stages)
    side_by_side = counted.agg(*[
        F.max(F.when(F.col("stage") == name, F.col("row_count"))).alias(f"n{i}") for i, name in enumerate(names)
    ])
    return _rows(side_by_side, [
        F.struct(
            F.lit(name).alias("stage"),
            F.col(f"n{i}").alias("row_count"),
            (F.col(f"n{i}") == F.col("n0")).alias("matches"),
        )
        for i, name in enumerate(names)
    ])


def schema_issues(
    schema: StructType, declared: Sequence[DeclaredColumn], mode: str = "full"
) -> list[tuple[str, str, str | None, str | None]]:
    """(column, issue, declared type, actual type) wherever a schema departs from a declaration.

    MISSING_COLUMN and TYPE_MISMATCH, and in mode ``full`` EXTRA_COLUMN.
    """
    if mode not in ("full", "partial"):
        raise ValueError(f"mode must be 'full' or 'partial', not {mode!r}")
    fields = {f.name.lower(): f for f in schema.fields}
    issues = []
    for d in declared:
        f = fields.pop(d.name.lower(), None)
        if f is None:
            issues.append((d.name, "MISSING_COLUMN", d.dtype, None))
        elif not agrees_with_spark(d.dtype, f.dataType):
            issues.append((d.name, "TYPE_MISMATCH", d.dtype, spark_type_to_declared(f.dataType)))
    if mode == "full":
        issues += [(f.name, "EXTRA_COLUMN", None, spark_type_to_declared(f.dataType)) for f in fields.values()]
    return issues


def names_conform(schema: StructType, declared: Sequence[DeclaredColumn]) -> bool:
    """Whether all declared columns are there. Columns beyond them are allowed, with a warning."""
    found = schema_issues(schema, declared)
    extra = [name for name, issue, _, _ in found if issue == "EXTRA_COLUMN"]
    if extra:
        warnings.warn(f"column(s) {extra} are not declared", stacklevel=2)
    return not any(issue == "MISSING_COLUMN" for _, issue, _, _ in found)


def conformance(df: DataFrame, declared: Sequence[DeclaredColumn], mode: str = "full") -> DataFrame:
    """Where a table departs from its declaration.

    The schema's issues (see :func:`schema_issues`) come with no row count.
    Rows are counted in one pass: BAD_VALUE does not fit the declared type (out
    of its range, or with a fraction that it cannot hold),
    TOO_LONG exceeds the declared length, NULL_VALUE is a NULL in a column
    declared to have none.
    """
    issues, counts = _conformance_counts(df.schema, declared, mode)
    # with nothing to count no row is read
    found = df.agg(*counts) if counts else df.limit(0).agg(F.count(F.lit(1)))
    structs = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(issue).alias("issue"),
            F.lit(wanted).cast("string").alias("declared_type"),
            F.lit(actual).cast("string").alias("actual_type"),
            rows.cast("bigint").alias("bad_rows"),
        )
        for name, issue, wanted, actual, rows in issues or [("", "", None, None, F.lit(0))]
    ]
    return _rows(found, structs).filter("bad_rows is null or bad_rows > 0")


def _conformance_counts(schema: StructType, declared: Sequence[DeclaredColumn], mode: str) -> tuple[list[tuple], list[Column]]:
    """The issues with the column that will hold each one's count, and the aggregates that count them."""
    fields = {f.name.lower(): f for f in schema.fields}
    issues = [(*found, F.lit(None)) for found in schema_issues(schema, declared, mode)]
    counts: list[Column] = []

    def count(d: DeclaredColumn, issue: str, actual: str, test: Column) -> None:
        name = f"n{len(counts)}"
        counts.append(F.count_if(test).alias(name))
        issues.append((d.name, issue, d.dtype, actual, F.col(name)))

    for d in declared:
        f = fields.get(d.name.lower())
        if f is None:
            continue
        actual = spark_type_to_declared(f.dataType)
        spark_type, length = declared_type_to_spark(d.dtype)
        c = col(f.name)
        if spark_type != f.dataType and not isinstance(spark_type, StringType):
            count(d, "BAD_VALUE", actual, c.isNotNull() & ~_holds(c, f.dataType, declared_value_type(d.dtype)))
        if length is not None:
            count(d, "TOO_LONG", actual, F.char_length(c.cast("string")) > length)
        if not d.nullable:
            count(d, "NULL_VALUE", actual, c.isNull())
    return issues, counts


def _holds(c: Column, own: DataType, wanted: DataType) -> Column:
    """Whether a value can be cast to ``wanted`` without loss: in range, and no fraction cut off."""
    cast = safe_cast(c, wanted)
    fits = cast.isNotNull()
    if not isinstance(wanted, (IntegralType, DecimalType)):
        return fits
    if isinstance(own, (DoubleType, FloatType)):
        # a double holds decimals only nearly
        return fits & F.coalesce(F.abs(cast.cast("double") - c) < 1e-6, F.lit(False))
    if isinstance(own, StringType):
        # plain digits are judged by their text, however many there are; other spellings of numbers by their value
        text = F.trim(c)
        scale = wanted.scale if isinstance(wanted, DecimalType) else 0
        fraction = F.regexp_extract(text, "[.]([0-9]*)$", 1)
        cut_off = F.rtrim(F.substring(fraction, scale + 1, 1 << 20), F.lit("0"))
        plain = F.rlike(text, F.lit("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"))
        whole = F.when(plain, cut_off == "").otherwise(F.coalesce(cast == safe_cast(c, "decimal(38,18)"), F.lit(False)))
        return fits & whole
    if isinstance(own, DecimalType):
        return fits & F.coalesce(cast == c, F.lit(False))
    return fits


def _rows(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def table_checks(
    df: DataFrame,
    required: Sequence[str] = (),
    keys: Sequence[str] = (),
    bounds: Sequence[str] = (),
    declared: Sequence[DeclaredColumn] = (),
    mode: str = "full",
) -> DataFrame:
    """All checks of one table in one scan: ``check``, ``column_name``, ``detail`` and ``value`` (text, or NULL).

    ROW_COUNT; NULLS of each required column; KEYS, DUPLICATE_KEYS and
    WIDEST_KEY of the key; LEAST and GREATEST of each of ``bounds``; and the
    issues of :func:`conformance`. With a key, rows are first folded by it, each
    with the other checks' partial results, which is the only shuffle of more
    than one row a task; without one nothing but one row a task moves.
    """
    names = [find(df.columns, c, "required column") for c in required]
    ranged = [find(df.columns, c, "bounds column") for c in bounds]
    keyed = [find(df.columns, k, "key") for k in keys]
    issues, counts = _conformance_counts(df.schema, declared, mode) if declared else ([], [])
    sums = {"rows": F.count(F.lit(1))}
    sums |= {f"null{i}": F.count_if(col(n).isNull()) for i, n in enumerate(names)}
    sums |= {f"n{i}": c for i, c in enumerate(counts)}
    ends = {f"least{i}": (F.min, n) for i, n in enumerate(ranged)} | {f"most{i}": (F.max, n) for i, n in enumerate(ranged)}
    # a folded column may not be called like a key
    own = {c: f"_tm_{c}" for c in (*sums, *ends)}
    first = [*[c.alias(own[k]) for k, c in sums.items()], *[fn(col(n)).alias(own[k]) for k, (fn, n) in ends.items()]]
    key_aggregates = []
    if keyed:
        df = df.groupBy(*[col(k).alias(f"_tm_key{i}") for i, k in enumerate(keyed)]).agg(*first)
        first = [*[F.coalesce(F.sum(own[k]), F.lit(0)).alias(own[k]) for k in sums], *[fn(own[k]).alias(own[k]) for k, (fn, _) in ends.items()]]
        key_aggregates = [
            F.count(F.lit(1)).alias("keys"), F.count_if(col(own["rows"]) > 1).alias("repeated"),
            F.coalesce(F.max(own["rows"]), F.lit(0)).alias("widest"),
        ]
    one = df.agg(*first, *key_aggregates)
    found = one.select(*[col(own[c]).alias(c) for c in own], *(["keys", "repeated", "widest"] if keyed else []))
    lines = [("ROW_COUNT", None, None, col("rows"))]
    lines += [("NULLS", n, None, col(f"null{i}")) for i, n in enumerate(names)]
    lines += [(c, ",".join(keyed), None, col(v)) for c, v in (("KEYS", "keys"), ("DUPLICATE_KEYS", "repeated"), ("WIDEST_KEY", "widest")) if keyed]
    lines += [line for i, n in enumerate(ranged) for line in (("LEAST", n, None, col(f"least{i}")), ("GREATEST", n, None, col(f"most{i}")))]
    lines += [(issue, name, f"{wanted or ''} / {actual or ''}", rows) for name, issue, wanted, actual, rows in issues]
    optional = {issue for _, issue, *_ in issues}
    rows = _rows(found, [
        F.struct(
            F.lit(check).alias("check"), F.lit(name).cast("string").alias("column_name"), F.lit(detail).cast("string").alias("detail"),
            value.cast("string").alias("value"),
        )
        for check, name, detail, value in lines
    ])
    # an issue that no row has is none
    return rows.filter(~(col("check").isin(*optional) & (col("value").eqNullSafe("0")))) if optional else rows
