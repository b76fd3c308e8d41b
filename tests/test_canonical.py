"""Canonical text and what stands for it: one test per pair of types."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.canonical import (
    canonical_text,
    comparable,
    comparison_scales,
    comparison_text,
    dates_facing_timestamps,
    row_hash,
)
from tallymark.plans.reconcile import reconcile


def texts(spark, values, dtype, scale=None):
    schema = T.StructType([T.StructField("v", dtype)])
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(canonical_text(F.col("v"), schema["v"].dataType, scale)).collect()]


def equal(spark, left, left_type, right, right_type):
    """Whether the comparison takes two values as equal."""
    s = spark.createDataFrame([(1, left)], f"k int, v {left_type}")
    t = spark.createDataFrame([(1, right)], f"k int, v {right_type}")
    return reconcile(s, t, ["k"]).passed


def test_integers(spark):
    assert texts(spark, [5, -7, None], T.IntegerType()) == ["5", "-7", None]


def test_doubles_lose_noise_and_trailing_zeros(spark):
    values = [128129.02000000002, 5.20, 100.0, 0.0, -0.0, -0.0000001, 1e20, None]
    assert texts(spark, values, T.DoubleType()) == [
        "128129.02", "5.2", "100", "0", "0", "0", "100000000000000000000", None,
    ]


def test_doubles_out_of_range_keep_their_text(spark):
    values = [math.nan, math.inf, -math.inf, 1e300]
    assert texts(spark, values, T.DoubleType()) == ["NaN", "Infinity", "-Infinity", "1.0E300"]


def test_decimals_stay_exact(spark):
    values = [Decimal("123456789012345678.12"), Decimal("5.20"), Decimal("100.00"), Decimal("0.00")]
    assert texts(spark, values, T.DecimalType(38, 2), 2) == ["123456789012345678.12", "5.2", "100", "0"]


def test_whole_decimals_past_a_long(spark):
    assert texts(spark, [Decimal("12345678901234567890123")], T.DecimalType(38, 0), 0) == ["12345678901234567890123"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_small_decimals_print_plainly(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = [Decimal("0.0000000001"), Decimal("0"), Decimal("-12.5"), Decimal("1234567.0000000001")]
        assert texts(spark, values, T.DecimalType(30, 10), 10) == ["0.0000000001", "0", "-12.5", "1234567.0000000001"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_text_facing_a_number(spark):
    values = [" 18.60 ", "18.00", "-0.00", "007", "TRUE", "a1.50", "", None]
    assert texts(spark, values, T.StringType(), 2) == ["18.6", "18", "0", "007", "true", "a1.5", "", None]


def test_other_text(spark):
    values = [" TRUE ", "False", " x  y ", "5.20", "null", "", None]
    assert texts(spark, values, T.StringType()) == ["true", "false", "x  y", "5.20", "null", "", None]


def test_scales(spark):
    def scale(a, b):
        s, t = (T.StructType().add("v", x) for x in (a, b))
        return comparison_scales(s, t, ["v"]).get("v")

    assert scale("decimal(12,2)", "decimal(10,4)") == 4
    assert scale("decimal(12,2)", "double") == 2
    assert scale("string", "decimal(12,3)") == 3
    assert scale("double", "float") == 6
    assert scale("integer", "double") == 6
    assert scale("integer", "long") is None
    assert scale("string", "date") is None


@pytest.mark.parametrize(("left", "left_type", "right", "right_type"), [
    (5.2, "double", Decimal("5.20"), "decimal(12,2)"),
    (5.2, "double", "5.200", "string"),
    (Decimal("5.20"), "decimal(12,2)", "5.200", "string"),
    (Decimal("5.20"), "decimal(12,2)", Decimal("5.2"), "decimal(5,1)"),
    (0.0, "double", "-0.00", "string"),
    (0.0, "double", -0.0, "double"),
    (-0.0, "double", Decimal("0.00"), "decimal(12,2)"),
    (128129.02000000002, "double", 128129.02, "double"),
    (1.1, "float", 1.1, "double"),
    (1.1, "float", 1.1, "float"),
    (7, "int", 7, "bigint"),
    (7, "int", 7.0, "double"),
    (7, "int", "7", "string"),
    (7, "bigint", Decimal("7"), "decimal(38,0)"),
    ("1000024", "string", Decimal("1000024"), "decimal(38,0)"),
    (" TRUE ", "string", "true", "string"),
    (True, "boolean", "TRUE", "string"),
    (True, "boolean", True, "boolean"),
    (math.nan, "double", math.nan, "double"),
    (math.inf, "double", math.inf, "double"),
    (1e300, "double", 1e300, "double"),
    (None, "string", None, "double"),
    (None, "int", None, "int"),
])
def test_equal_pairs(spark, left, left_type, right, right_type):
    assert equal(spark, left, left_type, right, right_type)


@pytest.mark.parametrize(("left", "left_type", "right", "right_type"), [
    (Decimal("123456789012345678.12"), "decimal(38,2)", Decimal("123456789012345678.13"), "decimal(38,2)"),
    (None, "string", "null", "string"),
    ("", "string", None, "string"),
    (None, "double", 0.0, "double"),
    (7, "int", 8, "bigint"),
    (1.000001, "double", 1.000002, "double"),
    (math.inf, "double", -math.inf, "double"),
    (math.nan, "double", None, "double"),
    (7, "int", "7.0", "string"),
    ("00123", "string", "123", "string"),
    (True, "boolean", False, "boolean"),
])
def test_different_pairs(spark, left, left_type, right, right_type):
    assert not equal(spark, left, left_type, right, right_type)


def test_comparable_decides_as_text_does(spark):
    """For doubles the rounded value stands for its text."""
    values = [0.0, -0.0, 1e-7, -1e-7, 4e-7, 5e-7, 6e-7, 0.1 + 0.2, 0.3, 1 / 3, 123456789.1234564, 123456789.1234565,
              9007199254.740993, 9007199254.740992, 1e15 + 0.125, 1e15 + 0.25, 1e22, 1e31, 1e32, 1e33, 1e300, math.nan,
              math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kind = T.DoubleType()
    pairs = df.select(
        comparable(F.col("v"), kind, kind, 6).alias("c"), canonical_text(F.col("v"), kind, 6).alias("t")
    )
    a, b = pairs.toDF("c1", "t1"), pairs.toDF("c2", "t2")
    wrong = a.join(b, (F.col("c1") == F.col("c2")) != (F.col("t1") == F.col("t2")))
    assert wrong.collect() == []
    again = pairs.select(comparison_text(F.col("c"), kind, 6).alias("c"), "t").filter("not (c <=> t)")
    assert again.collect() == []


def test_row_hash_sees_where_a_null_is(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 4


def test_dates_facing_timestamps(spark):
    s = T.StructType().add("a", "date").add("b", "date").add("c", "timestamp")
    t = T.StructType().add("a", "timestamp_ntz").add("b", "date").add("c", "timestamp")
    assert dates_facing_timestamps(s, t, ["a", "b", "c"]) == ["a"]
