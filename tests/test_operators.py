"""Filters, joins, row numbers, checks and aggregates, on small frames and against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.operators.aggregates import group_rule
from tallymark.operators.checks import (
    conformance,
    fanout_summary,
    join_fanout,
    key_uniqueness,
    names_conform,
    null_check,
    require_no_nulls,
    row_count_check,
)
from tallymark.operators.filters import date_window, pk_filter, preview, where
from tallymark.operators.joins import lookup_join, positional_join
from tallymark.operators.keys import keys_in, keys_not_in
from tallymark.operators.rownumber import _placed, number_rows, number_within_keys, table_numbers
from tallymark.spec import DeclaredColumn
from tests.conftest import rows

DAYS = "select * from values (1, timestamp_ntz'2024-12-30 08:00:00'), (2, timestamp_ntz'2024-12-31 00:00:00')," \
       " (3, timestamp_ntz'2024-12-31 09:00:00'), (4, timestamp_ntz'2025-01-01 00:00:00'), (5, null) as t(id, At)"


def ids(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def test_date_window(spark):
    df = spark.sql(DAYS)
    assert ids(date_window(df)) == [1, 2, 3, 4, 5]
    assert ids(date_window(df, "range", "2024-12-31", "at")) == [2, 3, 4]
    assert ids(date_window(df, "range", date_to="2024-12-31", to_col="AT")) == [1, 2]
    assert ids(date_window(df, "range", date_to="2024-12-31", to_col="At", inclusive_day=True)) == [1, 2, 3]
    assert ids(date_window(df, "range", "2024-12-31", "at", "2024-12-31", "at")) == [2]
    text = df.withColumn("at", F.col("at").cast("date").cast("string"))
    assert ids(date_window(text, "range", date_to="2024-12-31", to_col="at", inclusive_day=True)) == [1, 2, 3]


@pytest.mark.parametrize("arguments", [
    {"mode": "some"}, {"mode": "range"}, {"mode": "range", "date_from": "2024-01-01"},
    {"mode": "range", "date_from": "2024-01-01", "from_col": "nope"}, {"mode": "range", "date_to": "2024-01-01"},
])
def test_date_window_refuses(spark, arguments):
    with pytest.raises(ValueError):
        date_window(spark.sql(DAYS), **arguments)


def test_pk_filter(spark):
    df = spark.range(10)
    assert ids(pk_filter(df, "ID")) == list(range(10))
    assert ids(pk_filter(df, "id", "range", 3, 5)) == [3, 4, 5]
    assert ids(pk_filter(df, "id", "range", upper=1)) == [0, 1]
    assert ids(pk_filter(df, "id", "set", values=[1, 7, 99])) == [1, 7]
    assert ids(pk_filter(df, "id", "set", values=range(5, 5000))) == [5, 6, 7, 8, 9]
    assert ids(pk_filter(df, "id", "set", values=spark.createDataFrame([(2,), (2,)], "Id int"))) == [2]
    two = df.withColumn("b", F.col("id") % 2)
    assert ids(pk_filter(two, ["id", "b"], "set", values=[(3, 1), (4, 1)])) == [3]
    for bad in ({"mode": "x"}, {"mode": "range"}, {"mode": "set"}):
        with pytest.raises(ValueError):
            pk_filter(df, "id", **bad)


def test_where_and_preview(spark):
    df = spark.range(20)
    assert where(df, "") is df and where(df, None) is df
    assert ids(where(df, "id > 17")) == [18, 19] and ids(where(df, F.col("id") < 1)) == [0]
    assert preview(df).count() == 5


def test_lookup_join_kinds(spark):
    main = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (5, "e")], "k int, v string")
    other = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n"), (9, "w")], "id int, name string")
    for how in ("left", "INNER", "Right", "full"):
        got = lookup_join(main, other, [("k", "id")], how, ["name"])
        want = main.join(other, F.col("k") == F.col("id"), how.lower()).select("k", "v", "name")
        assert rows(got) == rows(want), how
    with pytest.raises(ValueError, match="how"):
        lookup_join(main, other, [("k", "id")], "cross", ["name"])
    with pytest.raises(ValueError, match="rename"):
        lookup_join(main, other.withColumnRenamed("name", "V"), [("k", "id")], "left", ["V"])
    with pytest.raises(ValueError, match="not found"):
        lookup_join(main, other, [("k", "id")], "left", ["zzz"])


def test_composite_lookup(spark):
    main = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    other = spark.createDataFrame([(1, "a", 10), (1, "c", 20)], "k int, l string, n int")
    assert rows(lookup_join(main, other, [("k", "k"), ("l", "l")], "left", {"n": "m"})) == [(1, "a", 10), (1, "b", None)]


def test_null_safe_key_joins(spark):
    left = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    right = spark.createDataFrame([(None,), (3,)], "k int")
    assert rows(keys_not_in(left, right, ["k"])) == [(1,)]
    assert rows(keys_in(left, right, ["k"])) == rows(spark.createDataFrame([(3,), (None,)], "k int"))


def test_row_numbers_equal_a_window(spark):
    dice = random.Random(1)
    values = dice.sample(range(100000), 3000)
    df = spark.createDataFrame([(v,) for v in values], "k int").repartition(7)
    for options in ({}, {"unique": True}, {"partitions": 5}, {"unique": True, "partitions": 16}):
        found = {r["k"]: r["rn"] for r in number_rows(df, ["k"], **options).collect()}
        assert found == {v: i + 1 for i, v in enumerate(sorted(values))}, options


def test_row_numbers_with_ties_null_and_no_rows(spark):
    df = spark.createDataFrame([(None,)] * 3 + [(1,)] * 200 + [(2,)] * 5, "k int")
    found = number_rows(df, ["k"], partitions=6).collect()
    assert sorted(r["rn"] for r in found) == list(range(1, 209))
    by_key = {k: sorted(r["rn"] for r in found if r["k"] == k) for k in (None, 1, 2)}
    assert by_key == {None: [1, 2, 3], 1: list(range(4, 204)), 2: list(range(204, 209))}
    assert number_rows(df.filter("k = 99"), ["k"]).collect() == []
    with pytest.raises(ValueError):
        number_rows(df, [])


def test_row_numbers_write_keys_and_identities_only(spark):
    """Wide rows are neither sorted nor written; equal rows, NULLs and maps find their numbers again."""
    df = spark.range(300).select(
        (F.col("id") % 40).alias("k"), F.when(F.col("id") % 7 > 0, F.lit("x")).alias("v"),
        F.create_map(F.lit("b"), F.col("id") % 3, F.lit("a"), F.lit(1)).alias("m"),
    ).unionByName(spark.range(300).select(
        (F.col("id") % 40).alias("k"), F.when(F.col("id") % 7 > 0, F.lit("x")).alias("v"),
        F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.col("id") % 3).alias("m"),
    ))
    found = table_numbers(df, ["k"])
    placed = [f for f in found.numbers.inputFiles() if "/placed-" in f]
    assert placed and found.repeats
    schema = spark.read.parquet(placed[0].rsplit("/", 1)[0]).columns
    assert schema == ["k", "_tm_id_a", "_tm_id_b", "_tm_position"]
    numbered = number_rows(df, ["k"]).collect()
    assert sorted(r["rn"] for r in numbered) == list(range(1, 601))
    assert [r["k"] for r in sorted(numbered, key=lambda r: r["rn"])] == sorted(r["k"] for r in df.collect())
    text = lambda rs: sorted(repr((r["k"], r["v"], sorted(r["m"].items()))) for r in rs)
    assert text(numbered) == text(df.collect())


def test_row_numbers_of_a_plan_that_is_not_repeatable(spark):
    df = spark.range(500).select(F.rand().alias("k"))
    found = number_rows(df, ["k"]).collect()
    assert [r["k"] for r in sorted(found, key=lambda r: r["rn"])] == sorted(r["k"] for r in found) and len(found) == 500


def test_a_hot_key_is_spread_over_partitions(spark):
    """All rows equal: still no partition holds more than its share."""
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"))
    placed, repeats = _placed(df, ["k"], False, 8)
    assert repeats
    sizes = [r["count"] for r in placed.groupBy(F.shiftright("_tm_position", 33)).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500


@pytest.mark.parametrize("hot", [10**6, 10])
def test_numbers_within_keys(spark, hot):
    dice = random.Random(2)
    data = [(None if dice.random() < 0.1 else 1 if dice.random() < 0.4 else dice.randrange(50), i)
            for i in dice.sample(range(10000), 1500)]
    df = spark.createDataFrame(data, "k int, v int")
    found = {(r["k"], r["v"]): r["rn"] for r in number_within_keys(df, ["k"], ["v"], hot_key_rows=hot, partitions=8).collect()}
    want, seen = {}, Counter()
    for k, v in sorted(data, key=lambda r: r[1]):
        seen[k] += 1
        want[(k, v)] = seen[k]
    assert found == want


def test_positional_join(spark):
    a = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "ak int, av string")
    b = spark.createDataFrame([("y", 2), ("x", 1)], "bv string, bk int")
    c = spark.createDataFrame([(7,), (8,), (9,)], "ck int")
    got = positional_join(a, [(b, ["bk"]), (c, ["ck"])], ["ak"]).select("rn", "av", "bv", "ck")
    assert rows(got) == [(1, "a", "x", 7), (2, "b", "y", 8)]
    with pytest.raises(ValueError, match="more than one"):
        positional_join(a, [(a, ["ak"])], ["ak"])


def test_group_rule(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 5)], "g string, v int")
    got = group_rule(df, ["G"], {
        "s": ("SUM", "V"), "n": ("count", "v"), "m": ("avg", "v"), "lo": ("min", "v"), "hi": ("max", "v"),
        "d": F.countDistinct("v"),
    })
    assert rows(got) == [("a", 1, 1, 1.0, 1, 1, 1), ("b", 5, 1, 5.0, 5, 5, 1)]
    with pytest.raises(ValueError, match="aggregate"):
        group_rule(df, ["g"], {"x": ("median", "v")})


def test_null_checks(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(null_check(df, ["A", "b"])) == [("a", 1), ("b", 2)]
    require_no_nulls(df.filter("a = 1"), ["a"])
    with pytest.raises(ValueError, match="not found"):
        null_check(df, ["z"])


def test_uniqueness_counts_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "a int, b int")
    assert rows(key_uniqueness(df, ["a", "b"])) == [(None, 1, 2)]


def test_fanout(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (None,)], "id int")
    fan = join_fanout(left, right, [("k", "id")])
    assert rows(fan) == [(1, 2, 3, 6), (2, 1, 0, 1), (None, 1, 0, 1)]
    assert tuple(fanout_summary(fan).first()) == (4, 8, 2, 3)
    joined = left.join(right, left.k == right.id, "left").count()
    assert joined == 8
    assert tuple(fanout_summary(fan.filter("false")).first()) == (0, 0, 0, 0)


def test_row_count_check(spark):
    got = row_count_check({"a": spark.range(3), "b": spark.range(3), "c": spark.range(0)})
    assert rows(got) == [("a", 3, True), ("b", 3, True), ("c", 0, False)]


def test_conformance(spark):
    df = spark.createDataFrame(
        [("abc", "x", 1, None), ("12", "toolong", 2, None), (None, None, 3, 1.0)], "n string, s string, extra int, f double"
    )
    declared = [
        DeclaredColumn("N", "INT", nullable=False), DeclaredColumn("S", "VARCHAR(5)"), DeclaredColumn("F", "FLOAT"),
        DeclaredColumn("GONE", "DATE"),
    ]
    full = {(r["column_name"], r["issue"]): r["bad_rows"] for r in conformance(df, declared).collect()}
    assert full == {
        ("N", "TYPE_MISMATCH"): None, ("N", "BAD_VALUE"): 1, ("N", "NULL_VALUE"): 1, ("S", "TOO_LONG"): 1,
        ("GONE", "MISSING_COLUMN"): None, ("extra", "EXTRA_COLUMN"): None,
    }
    partial = {(r["column_name"], r["issue"]) for r in conformance(df, declared, "partial").collect()}
    assert partial == set(full) - {("extra", "EXTRA_COLUMN")}
    assert conformance(df.select("f"), declared[2:3]).collect() == []
    with pytest.raises(ValueError, match="mode"):
        conformance(df, declared, "loose")


def test_names_against_a_written_schema(spark):
    schema = spark.createDataFrame([(1, "x")], "A int, extra string").schema
    with pytest.warns(UserWarning, match="extra"):
        assert names_conform(schema, [DeclaredColumn("a", "BIGINT")])
    assert not names_conform(schema, [DeclaredColumn("a", "INT"), DeclaredColumn("b", "INT"), DeclaredColumn("EXTRA", "TEXT")])
