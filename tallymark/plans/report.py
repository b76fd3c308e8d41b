"""Reports on a comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.plans.reconcile import EXTRA, MISMATCH, MISSING, ReconCounts, ReconResult, check_diff_columns, reconcile
from tallymark.sources.files import write_csv

# Exit codes without and with differences, and for a run that a check or a server stopped.
EXIT_OK = 0
EXIT_ISSUES = 2
EXIT_DIFFERENCES = 3


def diff_by_type(diff: DataFrame) -> DataFrame:
    """How many key texts differ in each way, in a difference table that may have been read back. Records of one key
    text count once; :func:`records_by_type` counts records."""
    check_diff_columns(diff)
    return diff.groupBy("diff_type").agg(F.countDistinct("primary_key_value").alias("distinct_keys"))


def records_by_type(result: ReconResult) -> DataFrame:
    """How many records differ in each way."""
    counts = result.counts
    found = {MISSING: counts.missing_rows, EXTRA: counts.extra_rows, MISMATCH: counts.mismatched_rows}
    rows = [(kind, n) for kind, n in found.items() if n]
    return result.outcome.sparkSession.createDataFrame(rows, "diff_type string, record_count bigint")


def diff_by_column(diff: DataFrame) -> DataFrame:
    """How many differences each column has, most first."""
    check_diff_columns(diff)
    counted = diff.groupBy("column_name").agg(F.count(F.lit(1)).alias("diff_count"))
    return counted.orderBy(F.desc("diff_count"), "column_name")


def top_columns(diff: DataFrame, n: int) -> DataFrame:
    """The ``n`` columns with the most differences."""
    return diff_by_column(diff).limit(n)


def summarize(diff: DataFrame, counts: ReconCounts) -> DataFrame:
    """One row: all counts, the verdict and the exit code.

    The verdict follows from every kind of difference, extra rows too.
    ``diff_rows`` counts records, ``diff_cells`` the rows of the difference table.
    """
    check_diff_columns(diff)
    passed = counts.diff_rows == 0
    return diff.agg(F.count(F.lit(1)).alias("diff_cells")).select(
        *[F.lit(v).cast("bigint").alias(n) for n, v in counts.as_dict().items()],
        "diff_cells",
        F.lit("PASS" if passed else "FAIL").alias("verdict"),
        F.lit(exit_code(counts)).alias("exit_code"),
    )


def exit_code(counts: ReconCounts) -> int:
    return EXIT_OK if counts.diff_rows == 0 else EXIT_DIFFERENCES


def write_report(diff: DataFrame, path: str) -> None:
    """Write the difference table as CSV."""
    check_diff_columns(diff)
    write_csv(diff, path, mode="overwrite")


def compare_and_report(
    source: DataFrame, target: DataFrame, keys: Sequence[str], path: str, columns: Sequence[str] | None = None, **options
) -> ReconResult:
    """Compare, and write the difference report to ``path``. Options are those of :func:`reconcile`."""
    result = reconcile(source, target, keys, columns, **options)
    write_report(result.diff, path)
    return result
