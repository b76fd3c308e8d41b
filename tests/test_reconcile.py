from pathlib import Path

"""The comparison as a whole: the three methods, duplicates, NULL keys, servers, reports."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driver_queries.registry import orders_target, table
from tallymark.operators.checks import key_uniqueness
from tallymark.plans.reconcile import METHODS, DuplicateKeys, common_columns, recon_counts, reconcile
from tallymark.plans.report import compare_and_report, diff_by_column, diff_by_type, exit_code, records_by_type, summarize
from tallymark.sources.files import DIFF_COLUMNS, read_diff
from tests.conftest import rows


def brute_force(source, target, keys, columns):
    """The differences of two lists of dicts with unique keys, as Counter of diff rows."""
    def key(r):
        return tuple(r[k] for k in keys)

    def text(values):
        return "|".join("" if v is None else str(v) for v in values)

    s, t = {key(r): r for r in source}, {key(r): r for r in target}
    out = []
    for k, r in s.items():
        if k not in t:
            out.append((text(k), "UNKNOWN", "<ENTIRE_ROW>", "<PRESENT_IN_SOURCE>", "<MISSING_IN_TARGET>",
                        "MISSING_IN_TARGET"))
            continue
        for c in columns:
            if r[c] != t[k][c]:
                a, b = (None if v is None else str(v) for v in (r[c], t[k][c]))
                out.append((text(k), "UNKNOWN", c, a, b, "VALUE_MISMATCH"))
    for k in t:
        if k not in s:
            out.append((text(k), "N/A", "<ENTIRE_ROW>", "<EXTRA_IN_TARGET>", "<PRESENT_IN_TARGET>", "EXTRA_IN_TARGET"))
    return Counter(out)


SCHEMA = "k1 int, k2 string, a string, b int"
RECORD = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "", "x"]),
                   st.sampled_from([None, "p", "q"]), st.sampled_from([None, 0, 1]))
TABLE = st.lists(RECORD, max_size=12, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(source=TABLE, target=TABLE)
def test_methods_agree_with_brute_force(spark, source, target):
    s, t = spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA)
    names = ["k1", "k2", "a", "b"]
    expected = brute_force([dict(zip(names, r)) for r in source], [dict(zip(names, r)) for r in target],
                           ["k1", "k2"], ["a", "b"])
    for method in METHODS:
        result = reconcile(s, t, ["K1", "K2"], method=method)
        assert Counter(map(tuple, result.diff.collect())) == expected, method
        assert result.counts.source_rows == len(source) and result.counts.target_rows == len(target)
        assert result.passed == (not expected)


def test_known_counts(spark, sf_dir):
    source, target = table(spark, sf_dir, "orders"), orders_target(spark, sf_dir)
    for method in METHODS:
        result = reconcile(source, target, ["o_orderkey"], method=method)
        c = result.counts
        assert (c.missing_rows, c.extra_rows, c.mismatched_rows) == (89, 66, 154)
        assert (c.source_rows, c.target_rows, c.matched_rows) == (1500, 1477, 1257)
        assert result.diff.columns == list(DIFF_COLUMNS)
        assert result.diff.count() == 89 + 66 + 157
    snap = reconcile(source, target, ["o_orderkey"], snapshot=True)
    assert rows(snap.diff) == rows(result.diff)


def test_swapping_sides_swaps_missing_and_extra(spark, sf_dir):
    source, target = table(spark, sf_dir, "orders"), orders_target(spark, sf_dir)
    a, b = reconcile(source, target, ["o_orderkey"]), reconcile(target, source, ["o_orderkey"])
    assert (a.counts.missing_rows, a.counts.extra_rows) == (b.counts.extra_rows, b.counts.missing_rows)
    assert a.counts.mismatched_rows == b.counts.mismatched_rows
    cells = "diff_type = 'VALUE_MISMATCH'"
    swapped = b.diff.filter(cells).select("primary_key_value", "column_name", "actual_value", "expected_value")
    kept = a.diff.filter(cells).select("primary_key_value", "column_name", "expected_value", "actual_value")
    assert rows(swapped) == rows(kept)


def test_a_table_equals_itself(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    for method in METHODS:
        result = reconcile(orders, orders, ["o_orderkey"], method=method)
        assert result.passed and result.diff.count() == 0 and result.diff.columns == list(DIFF_COLUMNS)
        assert exit_code(result.counts) == 0


def test_names_match_in_any_case_and_order(spark):
    s = spark.createDataFrame([(1, "a", 2.0)], "Id int, Name string, Price double")
    t = spark.createDataFrame([(2.0, 1, "a")], "PRICE double, ID int, NAME string")
    assert reconcile(s, t, ["iD"]).passed
    assert common_columns(s, t, ["ID"]) == ["name", "price"]


def test_excluded_columns_are_not_compared(spark):
    s = spark.createDataFrame([(1, "a", "x")], "k int, v string, LOAD_TS string")
    t = spark.createDataFrame([(1, "a", "y")], "k int, v string, load_ts string")
    assert reconcile(s, t, ["k"]).passed
    assert not reconcile(s, t, ["k"], columns=["v", "load_ts"]).passed
    assert not reconcile(s, t, ["k"], exclude=()).passed


def test_key_alone(spark):
    s = spark.createDataFrame([(1,), (2,)], "k int")
    t = spark.createDataFrame([(2,), (3,)], "k int")
    for method in METHODS:
        c = reconcile(s, t, ["k"], method=method).counts
        assert (c.missing_rows, c.extra_rows, c.matched_rows) == (1, 1, 1)


def test_null_keys_meet(spark):
    s = spark.createDataFrame([(None, "x"), ("1", "y")], "k string, v string")
    t = spark.createDataFrame([(None, "x"), ("2", "y")], "k string, v string")
    for method in METHODS:
        c = reconcile(s, t, ["k"], method=method).counts
        assert (c.source_rows, c.target_rows, c.matched_rows, c.missing_rows, c.extra_rows) == (2, 2, 1, 1, 1)


def test_keys_of_different_types_meet(spark):
    s = spark.createDataFrame([("1.50", "x")], "k string, v string")
    t = spark.createDataFrame([(1.5, "x")], "k double, v string").withColumn("k", F.col("k").cast("decimal(10,1)"))
    assert reconcile(s, t, ["k"]).passed


def test_keys_that_read_alike_are_not_merged(spark):
    s = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 1), (None, "z", 1), ("", "z", 1)], "k string, l string, v int")
    t = s.filter("false")
    for method in METHODS:
        result = reconcile(s, t, ["k", "l"], method=method)
        assert result.counts.missing_rows == 4 and result.diff.count() == 4


def test_repeated_keys_are_refused(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (2, "c")], "k int, v string")
    for method in METHODS:
        with pytest.raises(DuplicateKeys, match="1 key"):
            reconcile(s, t, ["k"], method=method)
        with pytest.raises(DuplicateKeys):
            reconcile(t, s, ["k"], method=method)
    assert rows(key_uniqueness(s, ["k"])) == [(1, 2)]
    assert recon_counts(s, t, ["k"]).first()["duplicate_keys"] == 1


def ordinal_brute_force(source, target):
    """Pair the rows of each key in sorted order."""
    def by_key(table_rows):
        groups = {}
        for k, v in sorted(table_rows, key=lambda r: (r[0], r[1] is not None, r[1] or "")):
            groups.setdefault(k, []).append(v)
        return groups

    s, t, out = by_key(source), by_key(target), Counter()
    for k in set(s) | set(t):
        left, right = s.get(k, []), t.get(k, [])
        for i in range(max(len(left), len(right))):
            if i >= len(right):
                out[(str(k), "<ENTIRE_ROW>", "MISSING_IN_TARGET")] += 1
            elif i >= len(left):
                out[(str(k), "<ENTIRE_ROW>", "EXTRA_IN_TARGET")] += 1
            elif left[i] != right[i]:
                out[(str(k), "v", "VALUE_MISMATCH")] += 1
    return out


@pytest.mark.parametrize("hot_key_rows", [10**6, 20])
def test_repeated_keys_are_paired_in_order(spark, hot_key_rows):
    """One key holds a third of all rows, many of them equal; small and large groups give the same."""
    dice = random.Random(3)
    source = [(1, dice.choice([None, "a", "b", "b", "b"])) for _ in range(100)]
    source += [(dice.randrange(2, 60), dice.choice("abc")) for _ in range(200)]
    target = [r for r in source if dice.random() > 0.1] + [(1, "z")] * 15
    s, t = spark.createDataFrame(source, "k int, v string"), spark.createDataFrame(target, "k int, v string")
    expected = ordinal_brute_force(source, target)
    for method in METHODS:
        result = reconcile(s, t, ["k"], method=method, on_duplicate="ordinal", hot_key_rows=hot_key_rows)
        found = Counter((r[0], r[2], r[5]) for r in result.diff.collect())
        assert found == expected, method
        assert result.counts.source_rows == 300 and result.counts.target_rows == len(target)


def test_server_of_each_difference(spark):
    s = spark.createDataFrame([(1, "a", "s0"), (2, "b", "s1"), (3, "c", None), (4, "d", "")],
                              "k int, v string, _source_server string")
    t = spark.createDataFrame([(1, "z"), (9, "a")], "k int, v string")
    for method in METHODS:
        found = {(r[0], r[1], r[5]) for r in reconcile(s, t, ["k"], method=method).diff.collect()}
        assert found == {
            ("1", "s0", "VALUE_MISMATCH"), ("2", "s1", "MISSING_IN_TARGET"), ("3", "UNKNOWN", "MISSING_IN_TARGET"),
            ("4", "UNKNOWN", "MISSING_IN_TARGET"), ("9", "N/A", "EXTRA_IN_TARGET"),
        }


def test_dates_and_timestamps(spark):
    s = spark.sql("select 1 k, date'2024-01-01' v")
    t = spark.sql("select 1 k, timestamp_ntz'2024-01-01 00:00:00' v")
    assert not reconcile(s, t, ["k"]).passed
    assert reconcile(s, t, ["k"], temporal="promote").passed


def test_forced_types(spark):
    s = spark.createDataFrame([(1, "007")], "k int, v string")
    t = spark.createDataFrame([(1, 7)], "k int, v int")
    assert not reconcile(s, t, ["k"]).passed
    assert reconcile(s, t, ["k"], force_types={"V": "int"}).passed


def test_extra_rows_alone_fail(spark):
    s = spark.createDataFrame([(1, "a")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    result = reconcile(s, t, ["k"])
    row = summarize(result.diff, result.counts).first()
    assert (row["verdict"], row["exit_code"], row["matched_rows"], row["extra_rows"]) == ("FAIL", 3, 1, 1)


def test_report(spark, tmp_path):
    s = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "")], "k int, v string, w string")
    t = spark.createDataFrame([(1, "b", ""), (3, "c", None)], "k int, v string, w string")
    result = compare_and_report(s, t, ["k"], str(tmp_path / "report"))
    assert rows(read_diff(spark, str(tmp_path / "report"))) == rows(result.diff)
    assert dict(map(tuple, diff_by_type(result.diff).collect())) == {"MISSING_IN_TARGET": 1, "VALUE_MISMATCH": 2}
    assert dict(map(tuple, records_by_type(result).collect())) == {"MISSING_IN_TARGET": 1, "VALUE_MISMATCH": 2}
    assert [tuple(r) for r in diff_by_column(result.diff).collect()] == [("w", 2), ("<ENTIRE_ROW>", 1), ("v", 1)]
    empty = compare_and_report(s, s, ["k"], str(tmp_path / "empty"))
    assert empty.passed and rows(read_diff(spark, str(tmp_path / "empty"))) == []
    with pytest.raises(ValueError, match="lacks"):
        diff_by_type(result.diff.drop("source_server"))


def test_bad_arguments(spark):
    s = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="method"):
        reconcile(s, s, ["k"], method="x")
    with pytest.raises(ValueError, match="on_duplicate"):
        reconcile(s, s, ["k"], on_duplicate="x")
    with pytest.raises(ValueError, match="temporal"):
        reconcile(s, s, ["k"], temporal="x")
    with pytest.raises(ValueError, match="key"):
        reconcile(s, s, [])
    with pytest.raises(ValueError, match="not found"):
        reconcile(s, s, ["nope"])
    with pytest.raises(ValueError, match="only by case"):
        reconcile(s.toDF("k", "K"), s, ["k"])


def test_a_null_key_is_looked_up_like_any_other(spark):
    s = spark.createDataFrame([(None, "a", "n"), (1, "b", "n"), (2, "c", "s"), (4, "e", "s")],
                              "k int, v string, _source_server string")
    t = spark.createDataFrame([(None, "x"), (1, "y"), (3, "d"), (4, "e")], "k bigint, v string")
    assert len(rows(reconcile(s, t, ["k"]).diff)) == 4


def test_forced_types_never_turn_a_difference_into_a_match(spark):
    s = spark.createDataFrame([(1, "abc"), (2, "1"), (3, "x"), (4, None)], "k int, v string")
    t = spark.createDataFrame([(1, "xyz"), (2, " 01"), (3, "x"), (4, "y")], "k int, v string")
    result = reconcile(s, t, ["k"], force_types={"v": "int"})
    assert (result.counts.matched_rows, result.counts.mismatched_rows) == (2, 2)


def test_a_missing_row_is_blamed_on_the_last_server(spark):
    s = spark.createDataFrame([(1, "a", "s1"), (1, "a", "s0")], "k int, v string, _source_server string")
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    for source in (s, s.orderBy("_source_server")):
        found = reconcile(source, t, ["k"], on_duplicate="ordinal").diff.collect()
        assert [r["source_server"] for r in found] == ["s1"]


def test_counts_equal_the_written_rows_and_release_deletes_them(spark, sf_dir):
    from driver_queries.registry import orders_target, table

    for method in ("hash", "full", "anti"):
        result = reconcile(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"], method=method)
        written = {r[0]: r[1] for r in result.outcome.groupBy("_tm_status").count().collect()}
        assert written == {
            "MISSING_IN_TARGET": result.counts.missing_rows, "EXTRA_IN_TARGET": result.counts.extra_rows,
            "VALUE_MISMATCH": result.counts.mismatched_rows,
        }
        assert result.diff.count() > 0
        files = [f.removeprefix("file://").removeprefix("file:") for f in (*result.outcome.inputFiles(), *result.diff.inputFiles())]
        result.release()
        assert files and not any(Path(f).exists() for f in files)


def test_records_of_like_key_texts_are_told_apart(spark):
    s = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 1)], "k string, l string, v int")
    result = reconcile(s, s.limit(0), ["k", "l"])
    assert records_by_type(result).first()["record_count"] == 2
