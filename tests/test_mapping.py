"""Rules, null handling, global rules and whole maps, on small frames."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions import rules as R
from tallymark.functions.global_rules import apply_global_rule, chosen_columns
from tallymark.functions.nulls import fill, handling_from_notes
from tallymark.functions.types import (
    agrees_with_spark,
    declared_type_to_spark,
    types_compatible,
    warehouse_type,
)
from tallymark.operators.checks import NullsFound
from tallymark.operators.mapping import (
    apply_column_rules,
    apply_hook,
    apply_mapping,
    conform_columns,
    select_partial,
)
from tallymark.spec import ColumnMap, GlobalRule, LookupJoin, TableMap
from tests.conftest import rows


def run(spark, rule, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"c {dtype}")
    return df.select(rule.build("c")).first()[0]


def test_text_rules(spark):
    df = spark.createDataFrame([("  aBc ",)], "c string")
    built = {
        "upper": R.upper(), "lower": R.lower(), "trim": R.trim(), "both": R.upper_trim(), "lt": R.ltrim(),
        "rt": R.rtrim(), "sub": R.substring(R.VAL, 3, 2), "left": R.left(R.VAL, 4), "right": R.right(R.VAL, 2),
        "lpad": R.lpad(R.VAL, 8, "*"), "rpad": R.rpad(R.VAL, 3, "*"), "z": R.zfill(4), "s": R.to_text(),
        "chain": R.replace_chain([("aB", "."), (".", "$1"), ("c", "")]), "cat": R.concat(R.VAL_REF, "-", 1),
    }
    got = df.select(*[r.build("c").alias(n) for n, r in built.items()]).first().asDict()
    assert got == {
        "upper": "  ABC ", "lower": "  abc ", "trim": "aBc", "both": "ABC", "lt": "aBc ", "rt": "  aBc", "sub": "aB",
        "left": "  aB", "right": "c ", "lpad": "**  aBc ", "rpad": "  a", "z": "  aB", "s": "  aBc ", "chain": "  $1 ",
        "cat": "  aBc -1",
    }


def test_conditions_and_null(spark):
    df = spark.createDataFrame([(None,), ("Y",), ("N",)], "c string")
    got = df.select(
        "c",
        R.if_null(R.VAL, "none", R.VAL_REF).build("c"),
        R.if_not_null(R.VAL, 1, 0).build("c"),
        R.if_compare(R.VAL, "!=", "Y", 1, 0).build("c"),
        R.if_present_and(R.VAL, R.VAL, "==", "Y", "yes", "no").build("c"),
        R.if_condition("c = 'N'", 1, 0).build("c"),
        R.coalesce("?").build("c"),
    )
    assert rows(got) == rows(spark.createDataFrame(
        [(None, "none", 0, 0, "no", 0, "?"), ("Y", "Y", 1, 0, "yes", 0, "Y"), ("N", "N", 1, 1, "no", 1, "N")],
        "a string, b string, c int, d int, e string, f int, g string",
    ))


def test_casts_give_null_for_what_does_not_fit(spark):
    assert run(spark, R.cast("INT"), "abc") is None
    assert run(spark, R.cast("integer"), "12") == 12
    assert run(spark, R.cast("float"), "1.5") == 1.5
    assert str(run(spark, R.cast("decimal(5,1)"), "12.25")) == "12.3"
    assert run(spark, R.cast("boolean"), "true") is True


def test_constants(spark):
    df = spark.range(1)
    made = df.select(
        R.constant("CURRENT_TIMESTAMP").build("x").alias("ts"), R.constant("current_date()").build("x").alias("d"),
        R.constant("'NULL'").build("x").alias("q"), R.constant("-3").build("x").alias("n"),
        R.constant("NULL", "int").build("x").alias("v"), R.constant(7).build("x").alias("i"),
    )
    assert [t for _, t in made.dtypes] == ["timestamp", "date", "string", "int", "int", "int"]
    assert tuple(made.first())[2:] == ("NULL", -3, None, 7)


def test_concat_with_null_is_null(spark):
    assert run(spark, R.concat(R.VAL_REF, "x"), None) is None


def test_notes_state_defaults():
    assert handling_from_notes("DEFAULT 0 IF NULL") == "fill:0"
    assert handling_from_notes("set unspecified if null") == "fill:UNSPECIFIED"
    assert handling_from_notes("default 'n a'") == "fill:n a"
    assert handling_from_notes("Default X") == "fill:X"
    assert handling_from_notes("key column") == ""


def test_fillers_must_fit_the_type():
    c = F.lit
    with pytest.raises(ValueError, match="cannot fill"):
        fill(None, T.IntegerType(), "fill:N/A", "x")
    with pytest.raises(ValueError, match="cannot fill"):
        fill(None, T.DateType(), "fill_zero", "x")
    with pytest.raises(ValueError, match="cannot fill"):
        fill(None, T.DoubleType(), "fill:nan", "x")
    assert fill(c, T.DateType(), "fill_empty", "x") is c


def test_fill_in_each_type(spark):
    df = spark.createDataFrame([(None,) * 5], "s string, i int, d date, b boolean, t string")
    got = apply_column_rules(df, [
        ColumnMap("s", "s", null_handling="fill_zero"), ColumnMap("i", "i", notes="DEFAULT 7 IF NULL"),
        ColumnMap("d", "d", null_handling="fill:2024-01-02"), ColumnMap("b", "b", null_handling="fill:true"),
        ColumnMap("t", "t", null_handling="fill:007"),
    ]).first()
    assert (got.s, got.i, str(got.d), got.b, got.t) == ("0", 7, "2024-01-02", True, "7")


def test_constant_text(spark):
    got = apply_column_rules(spark.range(1), [
        ColumnMap("A", rule="EUR", kind="constant"), ColumnMap("B", rule="42", kind="constant", dtype="INT"),
        ColumnMap("C", rule="1 + 1", dtype="INT"),
    ])
    assert [str(v) for v in got.first()] == ["EUR", "42", "2"]


def test_rules_see_earlier_columns_as_they_came_out(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    got = apply_column_rules(df, [
        ColumnMap("A", "a", R.expression("A * 10", ["A"])),
        ColumnMap("B", "b", null_handling="fill:none"),
        ColumnMap("C", rule=R.concat(R.ref("B"), "-", R.ref("A"))),
        ColumnMap("D", rule="concat(C, '!')"),
    ])
    assert got.columns == ["A", "B", "C", "D"]
    assert rows(got) == [(10, "none", "none-10", "none-10!"), (20, "b", "b-20", "b-20!")]


def test_columns_may_change_places(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(apply_column_rules(df, [ColumnMap("a", "b"), ColumnMap("b", "a")])) == [(2, 1)]


def test_independent_rules_share_one_select(spark):
    df = spark.createDataFrame([tuple("x" * 60)], [f"c{i}" for i in range(60)])
    mapped = apply_column_rules(df, [ColumnMap(f"T{i}", f"c{i}", R.upper()) for i in range(60)])
    plan = mapped._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") <= 4


def test_map_checks():
    with pytest.raises(ValueError, match="twice"):
        TableMap([ColumnMap("a", "x"), ColumnMap("A", "y")])
    with pytest.raises(ValueError, match="needs a rule"):
        ColumnMap("a", "x", kind="cast")
    with pytest.raises(ValueError, match="kind"):
        ColumnMap("a", "x", kind="what")
    with pytest.raises(ValueError, match="null handling"):
        TableMap([ColumnMap("a", "x", null_handling="zap")]).required


def test_required_columns_are_counted(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "c")], "a int, b string")
    mapping = TableMap([ColumnMap("A", "a", null_handling="error"), ColumnMap("B", "b", null_handling="ERROR")])
    with pytest.raises(NullsFound) as caught:
        apply_mapping(df, mapping)
    assert caught.value.counts == {"A": 1, "B": 2}
    assert apply_mapping(df, mapping, null_check="off").count() == 3
    inline = apply_mapping(df.filter("a = 1"), mapping, null_check="inline")
    assert rows(inline.select("A")) == [(1,)]
    with pytest.raises(Exception, match="NULL in required column B"):
        inline.collect()
    with pytest.raises(ValueError, match="null_check"):
        apply_mapping(df, mapping, null_check="maybe")


def test_null_handling_skips_constants(spark):
    df = spark.createDataFrame([(1,)], "a int")
    mapping = TableMap([ColumnMap("A", "a"), ColumnMap("B", rule=R.constant("NULL"), null_handling="error")])
    assert rows(apply_mapping(df, mapping)) == [(1, None)]


def test_conditions_choose_columns():
    declared = [("ID", "NUMBER(10,0)"), ("NAME", "VARCHAR(20)"), ("NOTE", "TEXT"), ("RATE", "FLOAT"), ("DAY", "DATE")]
    assert chosen_columns("", declared) == ["ID", "NAME", "NOTE", "RATE", "DAY"]
    assert chosen_columns("all", declared) == chosen_columns("", declared)
    assert chosen_columns("dtype:varchar", declared) == ["NAME", "NOTE"]
    assert chosen_columns("dtype:INT", declared) == ["ID"]
    assert chosen_columns("dtype:DECIMAL", declared) == ["ID", "RATE"]
    assert chosen_columns("dtype:DATE", declared) == ["DAY"]
    assert chosen_columns("dtype:FLOAT", declared) == ["RATE"]
    assert chosen_columns("col:N*", declared) == ["NAME", "NOTE"]
    assert chosen_columns("col:n*", declared) == []
    assert chosen_columns("exclude:id, note", declared) == ["NAME", "RATE", "DAY"]
    with pytest.raises(ValueError):
        chosen_columns("like:x", declared)


def test_global_rules_leave_other_types_alone(spark):
    df = spark.createDataFrame([(" a.b  c ", 5)], "s string, n int")
    assert rows(apply_global_rule(df, "upper", (), ["s", "n"])) == [(" A.B  C ", 5)]
    assert rows(apply_global_rule(df, "STRIP_WHITESPACE", (), ["s", "n"])) == [("a.b c", 5)]
    assert rows(apply_global_rule(df, "REPLACE", (".", "_"), ["s"])) == [(" a_b  c ", 5)]
    assert rows(apply_global_rule(df, "REGEX_REPLACE", ("[a-c]", "x"), ["s"])) == [(" x.x  x ", 5)]
    assert rows(apply_global_rule(df, "CAST", ("string",), ["n", "nope"])) == [(" a.b  c ", "5")]
    with pytest.raises(ValueError, match="unknown"):
        apply_global_rule(df, "SHUFFLE", (), ["s"])


def test_partial_map_follows_what_rules_read():
    other = object()
    mapping = TableMap([
        ColumnMap("K", "k", key=True), ColumnMap("P", "p", source_key=True), ColumnMap("A", "a"),
        ColumnMap("B", rule=R.concat(R.ref("a_renamed"), R.ref("A"))), ColumnMap("R", "a_renamed"),
        ColumnMap("C", rule=R.upper("B")), ColumnMap("X", "x"), ColumnMap("L", "looked_up"),
    ], joins=[LookupJoin(other, [("k", "k")], "left", ["looked_up"])])
    part = select_partial(mapping, ["c"])
    assert part.targets == ["K", "P", "A", "B", "R", "C"] and part.joins == ()
    assert len(select_partial(mapping, ["L"]).joins) == 1
    with pytest.raises(ValueError, match="no such"):
        select_partial(mapping, ["nope"])
    with pytest.raises(ValueError, match="uses="):
        select_partial(TableMap([ColumnMap("A", "a"), ColumnMap("B", rule="a + 1")]), ["B"])


def test_hook(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rows(apply_hook(df, lambda d, book: d.withColumn("a", F.lit(book["a"])), {"a": 9})) == [(9,)]
    with pytest.raises(TypeError):
        apply_hook(df, lambda d: None)


def test_conform(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert conform_columns(df, ["B", "A"]).columns == ["B", "A"]
    with pytest.raises(ValueError, match="not found"):
        conform_columns(df, ["a", "z"])
    with pytest.warns(UserWarning, match="left out"):
        assert conform_columns(df, ["a", "z"], "warn").columns == ["a"]


def test_column_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(" x ", 1)], "`a.b` string, `c d` int")
    got = apply_mapping(df, TableMap([ColumnMap("x.y", "a.b", R.trim()), ColumnMap("c d", "c d")], [GlobalRule(1, "UPPER")]))
    assert got.columns == ["x.y", "c d"] and rows(got) == [("X", 1)]


def test_declared_types():
    assert warehouse_type("int") == "NUMBER(10,0)" and warehouse_type("decimal(12,2)") == "NUMBER(12,2)"
    assert warehouse_type("varchar(20)") == "VARCHAR(20)" and warehouse_type("GEOGRAPHY") == "GEOGRAPHY"
    assert declared_type_to_spark("NUMBER(12,2)") == (T.DecimalType(12, 2), None)
    assert declared_type_to_spark("number") == (T.DecimalType(38, 0), None)
    assert declared_type_to_spark("VARCHAR(20)") == (T.StringType(), 20)
    assert declared_type_to_spark("NVARCHAR(MAX)") == (T.StringType(), None)
    assert declared_type_to_spark("datetime") == (T.TimestampNTZType(), None)
    assert declared_type_to_spark("TIMESTAMP_TZ") == (T.TimestampType(), None)
    assert declared_type_to_spark("bool") == (T.BooleanType(), None)
    assert declared_type_to_spark("TINYINT(1)") == (T.BooleanType(), None)
    with pytest.raises(ValueError):
        declared_type_to_spark("GEOGRAPHY")
    with pytest.raises(ValueError):
        declared_type_to_spark("not a type!")


@pytest.mark.parametrize(("a", "b", "same"), [
    ("VARCHAR(50)", "varchar(100)", True), ("VARCHAR(50)", "CHAR(50)", False), ("DECIMAL(10,2)", "DECIMAL(12,2)", True),
    ("DECIMAL(10,2)", "DECIMAL(10,3)", False), ("DECIMAL(10,2)", "NUMERIC(10,2)", False), ("NUMBER(5)", "NUMBER(5,0)", True),
    ("NUMBER(5)", "NUMBER(6,0)", False), ("INT(11)", "INTEGER", True), ("TINYINT(1)", "BOOLEAN", True),
    ("DATETIME", "TIMESTAMP_NTZ", True), ("DATETIME2", "TIMESTAMP", True), ("LONGTEXT", "NVARCHAR(MAX)", True),
    ("INT", "BIGINT", False), ("DATE", "TIMESTAMP", False), ("SMALLINT(6)", "smallint", True),
])
def test_compatible_types(a, b, same):
    assert types_compatible(a, b) is same and types_compatible(b, a) is same


def test_declared_against_spark_types():
    assert agrees_with_spark("BIGINT", T.LongType()) and agrees_with_spark("NUMBER(19,0)", T.LongType())
    assert agrees_with_spark("FLOAT", T.DoubleType()) and agrees_with_spark("CHAR(5)", T.StringType())
    assert agrees_with_spark("NUMBER(12,2)", T.DecimalType(12, 2)) and agrees_with_spark("DATETIME", T.TimestampType())
    assert not agrees_with_spark("INT", T.LongType()) and not agrees_with_spark("DATE", T.StringType())
