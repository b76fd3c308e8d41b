"""A whole validation run: load, map, unite, check, compare, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.operators.checks import NullsFound, conformance
from tallymark.operators.filters import date_window, pk_filter
from tallymark.operators.mapping import apply_mapping, conform_columns, select_partial
from tallymark.plans.reconcile import DEFAULT_EXCLUDED, ReconResult, reconcile
from tallymark.plans.report import EXIT_ISSUES, exit_code, write_report
from tallymark.sources.servers import SERVER_COLUMN, load_servers, server_disagreements, union_servers
from tallymark.spec import DeclaredColumn, ServerSource, TableMap


@dataclass(frozen=True)
class ValidationJob:
    """Everything one run needs.

    ``maps`` holds a :class:`TableMap` per server. ``target`` gives the target
    table. ``declared`` describes it in full, ``source_declared`` the columns that
    each server's extract must have. ``date_range`` and ``key_filter`` are the arguments of
    :func:`date_window` and :func:`pk_filter` by name; they apply to both sides,
    under the target's column names. ``on_issue="fail"`` makes departures from
    the declarations decide the exit code. ``null_check`` is that of
    :func:`apply_mapping`; ``count`` counts them as the comparison reads the rows,
    and raises after it.
    """

    servers: Sequence[ServerSource]
    maps: Mapping[str, TableMap]
    target: Callable[[SparkSession], DataFrame]
    keys: Sequence[str]
    columns: Sequence[str] | None = None
    exclude: Sequence[str] = DEFAULT_EXCLUDED
    partial: Sequence[str] | None = None
    declared: Sequence[DeclaredColumn] = ()
    source_declared: Mapping[str, Sequence[DeclaredColumn]] = field(default_factory=dict)
    date_range: Mapping[str, object] = field(default_factory=dict)
    key_filter: Mapping[str, object] = field(default_factory=dict)
    null_check: str = "count"
    on_issue: str = "report"
    report_path: str | None = None
    options: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class ValidationOutcome:
    """The comparison (None if no server could be read), what departs from the declarations, why servers failed, and
    the exit code: 0 only if nothing differs, every server was read, and no check that counts found anything."""

    result: ReconResult | None
    conformance: DataFrame | None
    source_conformance: Mapping[str, DataFrame]
    failures: Mapping[str, str]
    exit_code: int


def mapped_source(loaded: Mapping[str, DataFrame], job: ValidationJob) -> tuple[DataFrame, NullWatch]:
    """All servers' rows in the target's shape, tagged with their server, and the watch over their NULLs."""
    maps = {n: select_partial(job.maps[n], job.partial) if job.partial else job.maps[n] for n in loaded}
    per_server = "off" if job.null_check == "count" else job.null_check
    mapped = {n: apply_mapping(df, maps[n], per_server) for n, df in loaded.items()}
    problems = server_disagreements(mapped, {n: m.keys for n, m in maps.items()})
    if problems:
        raise ValueError("servers disagree: " + "; ".join(problems))
    united = union_servers(mapped)
    watched = NullWatch({n: m.required for n, m in maps.items()} if job.null_check == "count" else {})
    return _filtered(watched.over(united), job), watched


class NullWatch:
    """Counts NULLs in what each server requires while the rows pass on their way into the comparison."""

    def __init__(self, required: Mapping[str, Sequence[str]]):
        self.asked = [(server, c) for server, columns in required.items() for c in columns]
        self.observation = Observation("nulls")

    def over(self, united: DataFrame) -> DataFrame:
        if not self.asked:
            return united
        return united.observe(self.observation, *[
            F.count_if((col(SERVER_COLUMN) == server) & col(c).isNull()).alias(f"n{i}")
            for i, (server, c) in enumerate(self.asked)
        ])

    def require_none(self) -> None:
        """To be called once a job has read all rows."""
        if not self.asked:
            return
        counts = self.observation.get
        found = {f"{server}.{c}": counts[f"n{i}"] for i, (server, c) in enumerate(self.asked) if counts[f"n{i}"]}
        if found:
            raise NullsFound(found)


def _load(spark: SparkSession, job: ValidationJob) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The servers that can be read, and why the others cannot."""
    names = [s.name for s in job.servers]
    if len(set(names)) != len(names):
        raise ValueError(f"a server is listed twice: {names}")
    loaded, failures = {}, {}
    for server in job.servers:
        try:
            loaded |= load_servers(spark, [server])
        except (PySparkException, ValueError) as problem:
            failures[server.name] = str(problem).splitlines()[0]
    return loaded, failures


def run_validation(spark: SparkSession, job: ValidationJob) -> ValidationOutcome:
    """Compare what the servers should have produced with what the target holds."""
    if job.on_issue not in ("report", "fail"):
        raise ValueError(f"on_issue must be 'report' or 'fail', not {job.on_issue!r}")
    loaded, failures = _load(spark, job)
    if not loaded:
        return ValidationOutcome(None, None, {}, failures, EXIT_ISSUES)
    source_issues = {n: conformance(loaded[n], d, "partial") for n, d in job.source_declared.items() if n in loaded}
    source, nulls = mapped_source(loaded, job)
    target = job.target(spark)
    issues = conformance(target, job.declared) if job.declared else None
    target = _filtered(target, job)
    if job.partial:
        target = conform_columns(target, [c for c in source.columns if c != SERVER_COLUMN])
    forced = {c: t for m in job.maps.values() for c, t in m.forced_types.items()}
    options = {"force_types": forced, **job.options}
    result = reconcile(source, target, job.keys, job.columns, job.exclude, **options)
    try:
        nulls.require_none()
    except NullsFound:
        result.release()
        raise
    if job.report_path:
        write_report(result.diff, job.report_path)
    checks = [*source_issues.values(), *([] if issues is None else [issues])]
    stopped = failures or (job.on_issue == "fail" and any(not c.isEmpty() for c in checks))
    code = EXIT_ISSUES if stopped else exit_code(result.counts)
    return ValidationOutcome(result, issues, source_issues, failures, code)


def _filtered(df: DataFrame, job: ValidationJob) -> DataFrame:
    if job.date_range:
        df = date_window(df, **job.date_range)
    if job.key_filter:
        df = pk_filter(df, **job.key_filter)
    return df
