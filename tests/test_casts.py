"""The tests before a cast must let through everything that try_cast can cast."""

import math

import pytest
from pyspark.sql import functions as F

from tallymark.functions.casts import safe_cast
from tests.conftest import rows

TEXTS = [
    None, "", " ", "0", "-0", "+7", " 12 ", "\t12\n", "\x0012\x7f", "12.", "12.5", ".5", "-.5", ".", "1e3", "1E-3", "1e", "0x1F",
    "abc", "B12", "12B", "1 2", "99999999999", "-99999999999999999999", "NaN", "nan", "Infinity", "-inf", "+Inf", "inf ", "1d",
    "1.5f", "١٢", "１２", " 12", "true", "T", " yes ", "N", "no", "YES!", "falsey", "1", "off", "2024-01-01", "--1", "+-1", "1_000",
]
NUMBERS = [
    None, 0.0, -0.0, 1.5, -1.5, 127.9, 128.0, -128.9, -129.0, 2147483647.5, 2147483648.0, -2147483648.9, -2147483649.0, 9.2e18,
    9.223372036854775807e18, 9.3e18, -9.3e18, 99.94, 99.95, 99.99, 100.0, -99.96, 1e37, 1e38, 1e300, math.nan, math.inf, -math.inf,
]
TYPES = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(3,1)", "decimal(38,6)", "boolean", "date",
         "timestamp", "string"]
WHOLE = TYPES[:4]


@pytest.mark.parametrize(("values", "own"), [(TEXTS, "string"), (NUMBERS, "double"), (NUMBERS, "float")])
def test_same_as_try_cast(spark, values, own):
    df = spark.createDataFrame([(v,) for v in values], f"c {'string' if own == 'string' else 'double'}")
    df = df.select(F.col("c").cast(own))
    kinds = [t for t in TYPES if own == "string" or t not in ("date", "timestamp")]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for t in kinds:
                got = df.select("c", safe_cast(F.col("c"), t).cast("string"))
                plain = F.col("c")
                if own == "string" and t in WHOLE:
                    # text is cut at its decimal point, as a cast without ANSI rules does
                    plain = F.regexp_replace("c", r"(?<=[0-9])\.[0-9]*(?=[\x00-\x20\x7F]*$)", "")
                want = df.select("c", plain.try_cast(t).cast("string"))
                assert list(map(str, rows(got))) == list(map(str, rows(want))), t
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


def test_other_types_keep_a_plain_cast(spark):
    df = spark.range(3).select("id", F.col("id").cast("decimal(20,0)").alias("d"), (F.col("id") > 1).alias("b"))
    made = df.select(*[safe_cast(F.col(c), "int").alias(c) for c in df.columns])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "CASE" not in plan
    assert rows(made) == [(0, 0, 0), (1, 1, 0), (2, 2, 1)]
