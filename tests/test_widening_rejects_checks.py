"""Type widening over servers, reject tables, fused checks, Arrow rules and balanced scans."""

import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions import rules as R
from tallymark.operators.checks import conformance, key_uniqueness, null_check, table_checks
from tallymark.operators.rejects import split_rejects
from tallymark.operators.vectorised import ArrowRule, apply_arrow_rules
from tallymark.plans.validation import ValidationJob, run_validation
from tallymark.sources.jdbc import read_jdbc, scan_predicates
from tallymark.sources.servers import union_servers
from tallymark.sources.widening import common_schema, common_type, widen, widening
from tallymark.spec import ColumnMap, DeclaredColumn, ServerSource, TableMap
from tests.conftest import rows
from tests.test_plans import plan

TYPES = [
    T.ByteType(), T.IntegerType(), T.LongType(), T.DecimalType(12, 2), T.DecimalType(38, 10), T.DoubleType(), T.DateType(),
    T.TimestampNTZType(), T.TimestampType(), T.StringType(), T.BooleanType(),
]


def test_common_types_form_a_lattice():
    for a in TYPES:
        assert common_type(a, a) == a == common_type(a, T.NullType())
        for b in TYPES:
            c = common_type(a, b)
            assert c == common_type(b, a) and common_type(a, c) == c == common_type(c, b)
    assert common_type(T.IntegerType(), T.DecimalType(12, 2)) == T.DecimalType(12, 2)
    assert common_type(T.LongType(), T.DecimalType(12, 2)) == T.DecimalType(21, 2)
    assert common_type(T.DateType(), T.DoubleType()) == T.StringType()


def test_servers_are_widened_and_what_that_does_is_told(spark):
    servers = {
        "a": spark.sql("select 1 as id, cast(5 as int) as n, date'2024-01-02' as d, 'x' as t"),
        "b": spark.sql("select 2 as ID, cast(2.50 as decimal(5,2)) as n, timestamp_ntz'2024-01-02 03:00:00' as d, 7 as t"),
        "c": spark.sql("select 3 as id, 0.125D as n, 1.50 as t"),
    }
    changes = {(r["column_name"], r["server"]): (r["common_type"], r["change"]) for r in widening(servers).collect()}
    assert changes["n", "a"] == ("double", "WIDENED") and changes["n", "c"] == ("double", "SAME")
    assert changes["d", "a"] == ("timestamp_ntz", "WIDENED") and changes["d", "c"] == ("timestamp_ntz", "ABSENT")
    assert changes["t", "b"] == ("string", "TEXT")
    found = rows(union_servers(servers, widen_types=True).select("id", "n", "d", "t"))
    assert found == [
        (1, 5.0, dt.datetime(2024, 1, 2), "x"), (2, 2.5, dt.datetime(2024, 1, 2, 3), "7"), (3, 0.125, None, "1.5"),
    ]
    with pytest.raises(ValueError, match="is TEXT"):
        widen(servers, allow=["WIDENED"])
    big = {"a": spark.sql("select 1L as n"), "b": spark.sql("select 1D as n")}
    assert {r["server"]: r["change"] for r in widening(big).collect()} == {"a": "LOSSY", "b": "SAME"}
    with pytest.raises(ValueError, match="disagree"):
        union_servers(servers, strict=True)


def test_order_of_servers_does_not_matter(spark):
    frames = {"a": spark.sql("select 1 as c"), "b": spark.sql("select date'2024-01-01' as c"), "c": spark.sql("select 1.5D as c")}
    for names in ("abc", "bca", "cab"):
        assert common_schema({n: frames[n] for n in names})["c"].dataType == T.StringType()


# -- rejects -------------------------------------------------------------------------------


MAP = TableMap([
    ColumnMap("ID", "id", key=True, null_handling="error"),
    ColumnMap("N", "n", R.cast("int"), "INT", null_handling="fill:0"),
    ColumnMap("M", "n", R.cast("decimal(5,2)"), "DECIMAL(5,2)", null_handling="error"),
])


def test_rejects_and_good_rows(spark):
    data = [(1, "5"), (2, "x"), (None, "7"), (4, None), (5, "12345"), (None, "y"), (1, "5")]
    split = split_rejects(spark.createDataFrame(data, "id int, n string"), MAP)
    assert rows(split.good) == [(1, 5, Decimal("5.00")), (1, 5, Decimal("5.00"))]
    assert rows(split.rejects) == sorted([
        ("2", "N", "BAD_CAST", "x"), ("2", "M", "BAD_CAST", "x"), (None, "ID", "NULL_VALUE", None), ("4", "M", "NULL_VALUE", None),
        ("5", "M", "BAD_CAST", "12345"), (None, "N", "BAD_CAST", "y"), (None, "M", "BAD_CAST", "y"), (None, "ID", "NULL_VALUE", None),
    ], key=repr)
    assert split.rejected_rows == 5
    assert split.counts == {("N", "BAD_CAST"): 2, ("M", "BAD_CAST"): 3, ("ID", "NULL_VALUE"): 2, ("M", "NULL_VALUE"): 1}
    nothing = split_rejects(spark.createDataFrame([], "id int, n string"), MAP)
    assert nothing.good.collect() == [] and nothing.rejected_rows == 0 and nothing.counts == {}


def test_validation_counts_nulls_as_it_compares(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string").write.parquet(path)
    mapping = TableMap([ColumnMap("K", "k", key=True), ColumnMap("V", "v", null_handling="error")])
    job = ValidationJob([ServerSource("s", path, "parquet")], {"s": mapping}, lambda s: s.read.parquet(path), ["K"])
    with pytest.raises(ValueError, match=r"\{'s.V': 1\}"):
        run_validation(spark, job)
    spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string").write.mode("overwrite").parquet(path)
    assert run_validation(spark, job).exit_code == 0


# -- fused checks -----------------------------------------------------------------------------


DECLARED = [DeclaredColumn("k", "INT", nullable=False), DeclaredColumn("v", "VARCHAR(2)"), DeclaredColumn("w", "DATE")]


@pytest.mark.parametrize("keys", [[], ["k"], ["K", "v"]])
def test_fused_checks_equal_the_single_ones(spark, keys):
    df = spark.createDataFrame([(1, "a"), (1, "abc"), (None, "a"), (None, None), (2, "abcd"), (1, "a")], "k int, v string")
    found = {(r["check"], r["column_name"]): r["value"] for r in table_checks(df, ["k", "v"], keys, ["k"], DECLARED).collect()}
    assert found["ROW_COUNT", None] == "6" and (found["LEAST", "k"], found["GREATEST", "k"]) == ("1", "2")
    for r in null_check(df, ["k", "v"]).collect():
        assert found["NULLS", r["column_name"]] == str(r["null_count"])
    if keys:
        name = ",".join(k.lower() for k in keys)
        repeated = key_uniqueness(df, keys).collect()
        assert found["DUPLICATE_KEYS", name] == str(len(repeated))
        assert found["WIDEST_KEY", name] == str(max(r["row_count"] for r in repeated))
        assert found["KEYS", name] == str(df.select(*keys).distinct().count())
    single = {(r["issue"], r["column_name"]): r["bad_rows"] for r in conformance(df, DECLARED).collect()}
    issues = {k: v for k, v in found.items() if k[0] not in ("ROW_COUNT", "NULLS", "KEYS", "DUPLICATE_KEYS", "WIDEST_KEY", "LEAST", "GREATEST")}
    assert issues == {k: None if v is None else str(v) for k, v in single.items()}


def test_fused_checks_scan_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(table_checks(orders, ["o_orderstatus"], ["o_orderkey"], ["o_orderdate"], [DeclaredColumn("o_custkey", "INT")]))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    without = plan(table_checks(orders, ["o_orderstatus"], bounds=["o_orderdate"]))
    assert without.count("FileScan") == 1 and "hashpartitioning" not in without
    empty = {(r["check"], r["column_name"]): r["value"] for r in table_checks(orders.limit(0), ["o_orderkey"], ["o_orderkey"], ["o_custkey"]).collect()}
    assert empty["ROW_COUNT", None] == empty["NULLS", "o_orderkey"] == empty["WIDEST_KEY", "o_orderkey"] == "0"
    assert empty["LEAST", "o_custkey"] is None


# -- Arrow rules --------------------------------------------------------------------------------


def test_arrow_rules(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", 2.0), (3, None, 4.0)], "n int, `t.x` string, f double")

    def double(n):
        return pa.array([v * 2 for v in n.to_pylist()])

    def seen(n, t):
        return pa.array([f"{a}{b}" for a, b in zip(n.to_pylist(), t.to_pylist())])

    got = apply_arrow_rules(df, [ArrowRule("d", ["N"], "bigint", double), ArrowRule("s", ["n", "t.x"], "string", seen, nulls="pass"),
                                 ArrowRule("f", ["f"], "decimal(4,1)", lambda f: f)])
    assert got.columns == ["n", "t.x", "d", "s", "f"] and dict(got.dtypes)["f"] == "decimal(4,1)"
    assert rows(got) == sorted([(1, "a", 2, "1a", None), (None, "b", None, "Noneb", Decimal("2.0")), (3, None, 6, "3None", Decimal("4.0"))], key=repr)
    assert plan(got).count("MapInArrow") == 1
    assert apply_arrow_rules(df.limit(0), [ArrowRule("d", ["n"], "int", double)]).collect() == []
    assert apply_arrow_rules(df, []) is df


def test_arrow_rules_name_what_fails(spark):
    df = spark.range(20).withColumn("t", F.col("id").cast("string"))

    def picky(t):
        if "13" in t.to_pylist():
            raise RuntimeError("unlucky")
        return t

    with pytest.raises(Exception, match=r"rule 'p': on \('13',\): RuntimeError: unlucky"):
        apply_arrow_rules(df, [ArrowRule("p", ["t"], "string", picky)]).collect()
    with pytest.raises(Exception, match="gave 1 values for"):
        apply_arrow_rules(df.repartition(1), [ArrowRule("p", ["t"], "string", lambda t: pa.array(["x"]))]).collect()
    for bad in ([ArrowRule("p", ["t"], "int", picky, nulls="drop")], [ArrowRule("p", ["t"], "int", picky)] * 2):
        with pytest.raises(ValueError):
            apply_arrow_rules(df, bad)
    with pytest.raises(ValueError, match="not found"):
        apply_arrow_rules(df, [ArrowRule("p", ["zz"], "int", picky)])


# -- balanced scans ------------------------------------------------------------------------------


def test_scan_predicates(spark):
    df = spark.range(4000).select((F.col("id") * F.col("id")).alias("k"), F.lit("x").alias("t")).unionByName(
        spark.sql("select cast(null as bigint) as k, 'x' as t")
    )
    conditions = scan_predicates(df, "K", 5)
    sizes = [df.filter(c).count() for c in conditions]
    assert len(sizes) == 5 and sum(sizes) == 4001 and max(sizes) < 1.1 * min(sizes)
    hot = spark.range(900).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id")).alias("k"))
    conditions = scan_predicates(hot, "k", 9)
    assert sum(hot.filter(c).count() for c in conditions) == 900 and 2 <= len(conditions) < 9
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-04-01')) as d")
    assert scan_predicates(days, "d", 2)[1].startswith("d >= '2024-02-1")
    assert scan_predicates(df.limit(0), "k", 4) == scan_predicates(df, "k", 1) == ["1 = 1"]
    for bad in (("t", 3), ("k", 0), ("zz", 2)):
        with pytest.raises(ValueError):
            scan_predicates(df, *bad)
    with pytest.raises(ValueError, match="not both"):
        read_jdbc(spark, {"url": "jdbc:x"}, "select 1", ("a", 1, 2, 3), ["a < 1"])
