"""Mapping rules, null handling, global rules and whole maps."""

from __future__ import annotations

from dataclasses import replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from driver_queries.registry import TARGET_SQL, orders_target, query, table
from tallymark.functions import rules as R
from tallymark.operators.mapping import apply_column_rules, apply_mapping, conform_columns, select_partial
from tallymark.operators.rejects import split_rejects
from tallymark.operators.vectorised import ArrowRule, apply_arrow_rules
from tallymark.spec import ColumnMap, GlobalRule, LookupJoin, TableMap


def _rules(df, key, rules):
    """Map ``key`` through and one column per named rule."""
    return apply_column_rules(df, [ColumnMap(key, key), *[ColumnMap(n, rule=r, kind="derived") for n, r in rules.items()]])


@query("SELECT o_orderkey AS ORDER_KEY, o_totalprice, o_orderstatus AS STATUS FROM orders")
def map_direct_rename_drop(spark, sf_dir):
    return apply_column_rules(table(spark, sf_dir, "orders"), [
        ColumnMap("ORDER_KEY", "o_orderkey"),
        ColumnMap("o_totalprice", "o_totalprice"),
        ColumnMap("o_orderpriority", "o_orderpriority", kind="drop"),
        ColumnMap("STATUS", "o_orderstatus"),
    ])


@query("""SELECT l_orderkey, round(l_extendedprice, 1) AS price, CAST(l_quantity AS INTEGER) AS quantity,
    TRY_CAST(l_returnflag AS INTEGER) AS flag_number, CAST(l_partkey AS VARCHAR) AS part_text,
    CAST(l_shipdate AS DATE) AS ship_day, CAST(l_linenumber AS DOUBLE) AS line_double FROM lineitem""")
def map_cast_round(spark, sf_dir):
    return _rules(table(spark, sf_dir, "lineitem"), "l_orderkey", {
        "price": R.round_to(1, "l_extendedprice"),
        "quantity": R.cast("INT", "l_quantity"),
        "flag_number": R.cast("integer", "l_returnflag"),
        "part_text": R.cast("string", "l_partkey"),
        "ship_day": R.cast("date", "l_shipdate"),
        "line_double": R.cast("float", "l_linenumber"),
    })


@query("""SELECT o_orderkey, TRUE AS yes, FALSE AS no, CAST(NULL AS INTEGER) AS id, CAST(NULL AS DECIMAL(12,2)) AS nothing,
    'ETL_VALIDATION' AS batch, 'a b' AS quoted, 42 AS whole, CAST(1.5 AS DOUBLE) AS part, 'EUR' AS word,
    'IDENTITY' AS quoted_word, 'IDENTITY CARD' AS two_words, '007' AS zeros, 7 AS typed, '1e5' AS exponent FROM orders""")
def map_constants(spark, sf_dir):
    return _rules(table(spark, sf_dir, "orders"), "o_orderkey", {
        "yes": R.constant("TRUE"),
        "no": R.constant("false"),
        "id": R.constant("IDENTITY(1,1)"),
        "nothing": R.constant("NULL", "decimal(12,2)"),
        "batch": R.constant("SYS_BATCH_ID"),
        "quoted": R.constant("'a b'"),
        "whole": R.constant("42"),
        "part": R.constant("1.5"),
        "word": R.constant("EUR"),
        "quoted_word": R.constant("'IDENTITY'"),
        "two_words": R.constant("IDENTITY CARD"),
        "zeros": R.constant("007"),
        "typed": R.constant("007", "int"),
        "exponent": R.constant("1e5"),
    })


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus IS NULL THEN 'none' ELSE o_orderpriority END AS a,
    CASE WHEN o_orderstatus IS NOT NULL THEN 1 ELSE 0 END AS b FROM ({TARGET_SQL}) t""")
def map_ternary_null(spark, sf_dir):
    return _rules(orders_target(spark, sf_dir), "o_orderkey", {
        "a": R.if_null("o_orderstatus", "none", R.ref("o_orderpriority")),
        "b": R.if_not_null("o_orderstatus", 1, 0),
    })


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus IS NOT NULL AND o_totalprice > 100000 THEN o_orderstatus ELSE 'small' END AS a
    FROM ({TARGET_SQL}) t""")
def map_ternary_and(spark, sf_dir):
    return _rules(orders_target(spark, sf_dir), "o_orderkey", {
        "a": R.if_present_and("o_orderstatus", "o_totalprice", ">", 100000, R.ref("o_orderstatus"), "small"),
    })


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS eq,
    CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END AS ne, CASE WHEN o_totalprice < 150000 THEN 1 ELSE 0 END AS lt,
    CASE WHEN o_totalprice <= 150000 THEN 1 ELSE 0 END AS le, CASE WHEN o_custkey >= 700 THEN 1 ELSE 0 END AS ge,
    CASE WHEN o_orderkey > o_custkey THEN 1 ELSE 0 END AS gt FROM ({TARGET_SQL}) t""")
def map_ternary_compare(spark, sf_dir):
    """A NULL takes the other branch, for != as well."""
    return _rules(orders_target(spark, sf_dir), "o_orderkey", {
        "eq": R.if_compare("o_orderstatus", "==", "F", 1, 0),
        "ne": R.if_compare("o_orderstatus", "!=", "F", 1, 0),
        "lt": R.if_compare("o_totalprice", "<", 150000, 1, 0),
        "le": R.if_compare("o_totalprice", "<=", 150000, 1, 0),
        "ge": R.if_compare("o_custkey", ">=", 700, 1, 0),
        "gt": R.if_compare("o_orderkey", ">", R.ref("o_custkey"), 1, 0),
    })


@query("""SELECT c_custkey, upper(c_name) AS up, lower(c_name) AS low, trim(padded) AS t, ltrim(padded) AS lt,
    rtrim(padded) AS rt, upper(trim(padded)) AS ut
    FROM (SELECT *, '  ' || c_mktsegment || ' ' AS padded FROM customer) c""")
def map_case_trim(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn(
        "padded", F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    )
    return _rules(customer, "c_custkey", {
        "up": R.upper("c_name"), "low": R.lower("c_name"), "t": R.trim("padded"), "lt": R.ltrim("padded"),
        "rt": R.rtrim("padded"), "ut": R.upper_trim("padded"),
    })


@query(f"""SELECT o_orderkey, coalesce(o_orderstatus, 'X') AS a, coalesce(o_orderstatus, o_orderpriority) AS b,
    coalesce(o_orderstatus, '?') AS c FROM ({TARGET_SQL}) t""")
def map_coalesce(spark, sf_dir):
    return _rules(orders_target(spark, sf_dir), "o_orderkey", {
        "a": R.coalesce("X", "o_orderstatus"),
        "b": R.isnull(R.ref("o_orderpriority"), "o_orderstatus"),
        "c": R.ifnull("?", "o_orderstatus"),
    })


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'O' THEN o_orderpriority ELSE 'no' END AS a,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS b FROM orders""")
def map_if(spark, sf_dir):
    return _rules(table(spark, sf_dir, "orders"), "o_orderkey", {
        "a": R.if_condition("o_totalprice > 100000 and o_orderstatus = 'O'", R.ref("o_orderpriority"), "no"),
        "b": R.if_compare("o_orderstatus", "=", "P", 1, 2),
    })


@query("""SELECT p_partkey, substring(p_name, 3, 4) AS middle, left(p_type, 5) AS head, right(p_brand, 2) AS tail FROM part""")
def map_substring_left_right(spark, sf_dir):
    return _rules(table(spark, sf_dir, "part"), "p_partkey", {
        "middle": R.substring("p_name", 3, 4), "head": R.left("p_type", 5), "tail": R.right("p_brand", 2),
    })


@query("""SELECT o_orderkey, lpad(o_orderpriority, 12, '*') AS l, rpad(o_orderpriority, 4, '-') AS r,
    lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS z, CAST(o_custkey AS VARCHAR) AS s FROM orders""")
def map_pad_zfill(spark, sf_dir):
    return _rules(table(spark, sf_dir, "orders"), "o_orderkey", {
        "l": R.lpad("o_orderpriority", 12, "*"), "r": R.rpad("o_orderpriority", 4, "-"),
        "z": R.zfill(8, "o_custkey"), "s": R.to_text("o_custkey"),
    })


@query("""SELECT p_partkey, replace(replace(replace(p_brand, '#', '.'), '.', '_'), 'B', 'b') AS p_brand,
    replace(p_name, ' ', '$1') AS p_name FROM part""")
def map_replace_chain(spark, sf_dir):
    """Literal texts, also where they would mean something in a pattern."""
    return apply_column_rules(table(spark, sf_dir, "part"), [
        ColumnMap("p_partkey", "p_partkey"),
        ColumnMap("p_brand", "p_brand", R.replace_chain([("#", "."), (".", "_"), ("B", "b")])),
        ColumnMap("p_name", "p_name", R.replace_chain([(" ", "$1")])),
    ])


@query(f"""SELECT o_orderkey, o_orderstatus || '-' || o_orderpriority AS a FROM ({TARGET_SQL}) t""")
def map_concat(spark, sf_dir):
    """NULL where a part is NULL."""
    return _rules(orders_target(spark, sf_dir), "o_orderkey", {
        "a": R.concat(R.ref("o_orderstatus"), "-", R.ref("o_orderpriority")),
    })


@query("SELECT c_custkey, c_name || ' ' || c_mktsegment AS a FROM customer")
def map_plus(spark, sf_dir):
    return _rules(table(spark, sf_dir, "customer"), "c_custkey", {
        "a": R.plus(R.ref("c_name"), " ", R.ref("c_mktsegment")),
    })


@query("""SELECT l_orderkey, l_quantity * 2 - l_linenumber AS a, l_returnflag AS b, l_linenumber + 1 AS c FROM lineitem""")
def map_expr(spark, sf_dir):
    return _rules(table(spark, sf_dir, "lineitem"), "l_orderkey", {
        "a": R.expression("l_quantity * 2 - l_linenumber"),
        "b": R.column("l_returnflag"),
        "c": R.call(lambda c: c + 1, "l_linenumber"),
    })


@query(f"""SELECT o_orderkey, coalesce(o_orderstatus, '0') AS zero, o_orderstatus AS kept,
    coalesce(o_orderstatus, 'N/A') AS filled, coalesce(o_orderstatus, 'UNSPECIFIED') AS noted,
    coalesce(CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END, -1) AS num,
    coalesce(CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END, 0) AS price FROM ({TARGET_SQL}) t""")
def null_fill(spark, sf_dir):
    gaps = F.col("o_orderkey") % 13 != 0
    holed = orders_target(spark, sf_dir).withColumns({
        "num": F.when(gaps, F.col("o_custkey")), "price": F.when(gaps, F.col("o_totalprice")),
    })
    return apply_column_rules(holed, [
        ColumnMap("o_orderkey", "o_orderkey"),
        ColumnMap("zero", "o_orderstatus", null_handling="fill_zero"),
        ColumnMap("kept", "o_orderstatus", null_handling="fill_empty"),
        ColumnMap("filled", "o_orderstatus", null_handling="fill:N/A", notes="DEFAULT x IF NULL"),
        ColumnMap("noted", "o_orderstatus", notes="unspecified if null"),
        ColumnMap("num", "num", null_handling="fill:-1"),
        ColumnMap("price", "price", null_handling="fill_zero"),
    ])


@query(r"""SELECT doc_id,
    trim(regexp_replace(regexp_replace(replace(text, '. ', ' | '), '[ \t\n\x0B\f\r]+', ' ', 'g'), '[0-9]+', '#', 'g')) AS text,
    lpad(lower(lang), 5, '~') AS lang, rtrim(ltrim('  ' || upper(source) || '  ')) AS source, n_chars FROM documents""")
def global_text_rules(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumn("source", F.concat(F.lit("  "), "source", F.lit("  ")))
    return apply_mapping(documents, TableMap(
        [
            ColumnMap("doc_id", "doc_id", dtype="BIGINT", key=True),
            ColumnMap("text", "text", dtype="TEXT"),
            ColumnMap("lang", "lang", dtype="CHAR(5)"),
            ColumnMap("source", "source", dtype="VARCHAR(40)"),
            ColumnMap("n_chars", "n_chars", dtype="BIGINT"),
        ],
        [
            GlobalRule(7, "LPAD", (5, "~"), "col:la*"),
            GlobalRule(1, "REPLACE", (". ", " | "), "col:text"),
            GlobalRule(2, "STRIP_WHITESPACE", (), "dtype:VARCHAR"),
            GlobalRule(3, "REGEX_REPLACE", ("[0-9]+", "#"), "exclude:lang,source"),
            GlobalRule(4, "UPPER", (), "col:source"),
            GlobalRule(5, "LOWER", (), "col:lang"),
            GlobalRule(6, "TRIM"),
        ],
    ))


@query("""SELECT c_custkey, rpad(rtrim(upper(c_name)), 30, '.') AS c_name, c_nationkey,
    TRY_CAST(c_acctbal AS DECIMAL(12,1)) AS c_acctbal, ltrim(upper(c_mktsegment)) AS c_mktsegment FROM customer""")
def global_conditions(spark, sf_dir):
    return apply_mapping(table(spark, sf_dir, "customer"), TableMap(
        [
            ColumnMap("c_custkey", "c_custkey", dtype="BIGINT"),
            ColumnMap("c_name", "c_name", dtype="VARCHAR(25)"),
            ColumnMap("c_nationkey", "c_nationkey", dtype="INT"),
            ColumnMap("c_acctbal", "c_acctbal", dtype="DECIMAL(12,2)"),
            ColumnMap("c_mktsegment", "c_mktsegment", dtype="CHAR(10)"),
        ],
        [
            GlobalRule(1, "UPPER"),
            GlobalRule(2, "CAST", ("decimal(12,1)",), "dtype:DECIMAL"),
            GlobalRule(3, "RTRIM", (), "col:c_name"),
            GlobalRule(4, "LTRIM", (), "col:*segment"),
            GlobalRule(5, "RPAD", (30, "."), "exclude:C_MKTSEGMENT,C_CUSTKEY"),
        ],
    ))


def order_map(customer=None) -> TableMap:
    """Orders in the shape of a warehouse table."""
    columns = [
        ColumnMap("ORDER_KEY", "o_orderkey", dtype="NUMBER(19,0)", key=True, null_handling="error"),
        ColumnMap("STATUS", "o_orderstatus", R.upper_trim(), "VARCHAR(10)", null_handling="fill:N"),
        ColumnMap("IS_OPEN", rule=R.if_compare("STATUS", "==", "O", 1, 0), dtype="INT"),
        ColumnMap("PRICE", "o_totalprice", R.round_to(1), "DECIMAL(18,2)"),
        ColumnMap("PRICE_CLASS", rule=R.if_compare("PRICE", ">", 150000, "high", "low"), dtype="VARCHAR(4)"),
        ColumnMap("ORDER_DAY", "o_orderdate", R.cast("date"), "DATE"),
        ColumnMap("PRIORITY", "o_orderpriority", R.substring(R.VAL, 3, 20), "VARCHAR(20)"),
        ColumnMap("CURRENCY", rule=R.constant("EUR"), dtype="CHAR(3)"),
        ColumnMap("OLD_ID", rule=R.constant("NULL"), dtype="BIGINT"),
        ColumnMap("o_custkey", "o_custkey", kind="drop"),
    ]
    joins = []
    if customer is not None:
        columns.insert(-1, ColumnMap("SEGMENT", "c_mktsegment", dtype="VARCHAR(10)"))
        joins = [LookupJoin(customer, [("o_custkey", "c_custkey")], "left", ["c_mktsegment"])]
    return TableMap(columns, [GlobalRule(1, "LOWER", (), "col:PRI*"), GlobalRule(2, "TRIM")], joins)


_MAPPED_SQL = """SELECT o_orderkey AS ORDER_KEY, coalesce(upper(trim(o_orderstatus)), 'N') AS STATUS,
    CASE WHEN upper(trim(o_orderstatus)) = 'O' THEN 1 ELSE 0 END AS IS_OPEN, round(o_totalprice, 1) AS PRICE,
    CASE WHEN round(o_totalprice, 1) > 150000 THEN 'high' ELSE 'low' END AS PRICE_CLASS,
    CAST(o_orderdate AS DATE) AS ORDER_DAY, trim(lower(substring(o_orderpriority, 3, 20))) AS PRIORITY,
    'EUR' AS CURRENCY, CAST(NULL AS {old}) AS OLD_ID{more} FROM {source}"""


@query(_MAPPED_SQL.format(
    old="DECIMAL(19,0)", more=", c_mktsegment || '!' AS SEGMENT",
    source="orders LEFT JOIN customer ON o_custkey = c_custkey"))
def apply_mapping_orders(spark, sf_dir):
    """Lookup, rules in order, null handling, global rules, then a function of the user's own."""
    mapping = replace(
        order_map(table(spark, sf_dir, "customer")),
        hook=lambda df: df.withColumn("SEGMENT", F.concat("SEGMENT", F.lit("!"))),
    )
    return apply_mapping(table(spark, sf_dir, "orders"), mapping)


@query("SELECT o_orderpriority AS PRIORITY, o_orderkey AS KEY FROM orders")
def conform_order(spark, sf_dir):
    """The target's columns, in its order and its spelling."""
    orders = table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "key", "o_orderpriority": "priority"})
    return conform_columns(orders, ["PRIORITY", "KEY"])


@query("""SELECT o_orderkey AS ORDER_KEY, upper(trim(o_orderstatus)) AS STATUS,
    CASE WHEN upper(trim(o_orderstatus)) = 'O' THEN 1 ELSE 0 END AS IS_OPEN FROM orders""")
def partial_columns(spark, sf_dir):
    """One column asked for: its key and the column its rule reads come along."""
    return apply_mapping(table(spark, sf_dir, "orders"), select_partial(order_map(), ["is_open"]))


@query("""SELECT o_orderkey, o_custkey AS whole, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 0 - o_custkey END AS mixed FROM orders""")
def map_cast_text(spark, sf_dir):
    """Text with a fraction is cut to a whole number, other text is NULL."""
    number = F.col("o_custkey").cast("string")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(number, F.lit(".75")).alias("a"),
        F.when(F.col("o_orderkey") % 2 == 0, "1.5.2").otherwise(F.concat(F.lit(" -"), number, F.lit(". "))).alias("b"),
    )
    return _rules(orders, "o_orderkey", {"whole": R.cast("bigint", "a"), "mixed": R.cast("bigint", "b")})


_RAW_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer,
    CASE WHEN o_orderkey % 7 = 0 THEN '31.02.1996' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders"""


def _raw_orders(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 9 == 0, "n/a").when(key % 10 != 0, F.col("o_custkey").cast("string")).alias("customer"),
        F.when(key % 7 == 0, "31.02.1996").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("day"),
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("status"),
    )


_REJECT_MAP = TableMap([
    ColumnMap("ORDER_KEY", "o_orderkey", key=True),
    ColumnMap("CUSTOMER", "customer", R.cast("bigint"), "NUMBER(19,0)", null_handling="error"),
    ColumnMap("DAY", "day", R.cast("date"), "DATE"),
    ColumnMap("STATUS", "status", null_handling="fill:N"),
])


@query(f"""WITH r AS ({_RAW_SQL})
    SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER_KEY", 'CUSTOMER' AS column_name, 'BAD_CAST' AS reason, customer AS raw_text FROM r WHERE customer = 'n/a'
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'CUSTOMER', 'NULL_VALUE', NULL FROM r WHERE customer IS NULL
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'DAY', 'BAD_CAST', day FROM r WHERE day = '31.02.1996'""")
def rejects_table(spark, sf_dir):
    """Values that a cast loses and NULLs where there may be none, each with its key, column, reason and raw text."""
    return split_rejects(_raw_orders(spark, sf_dir), _REJECT_MAP).rejects


@query(f"""SELECT o_orderkey AS "ORDER_KEY", CAST(customer AS BIGINT) AS "CUSTOMER", CAST(day AS DATE) AS "DAY", coalesce(status, 'N') AS "STATUS"
    FROM ({_RAW_SQL}) r WHERE customer <> 'n/a' AND day <> '31.02.1996'""")
def rejects_good(spark, sf_dir):
    """The rows that go on."""
    return split_rejects(_raw_orders(spark, sf_dir), _REJECT_MAP).good


@query(f"""WITH t AS ({TARGET_SQL}), d AS (
      SELECT o_orderkey, sum(CAST(digit AS BIGINT))::BIGINT AS digits
      FROM (SELECT o_orderkey, unnest(string_split(CAST(o_custkey AS VARCHAR), '')) AS digit FROM t) u GROUP BY o_orderkey)
    SELECT t.o_orderkey, digits, coalesce(o_orderstatus, '?') || ':' || o_orderpriority AS label FROM t JOIN d USING (o_orderkey)""")
def arrow_rules(spark, sf_dir):
    """Two rules as Arrow functions, one over numbers and one over text with NULLs, in one stage."""
    rows = orders_target(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")

    def digit_sum(numbers):
        return pa.array([sum(map(int, str(n))) for n in numbers.to_pylist()], pa.int64())

    def label(status, priority):
        return pc.binary_join_element_wise(pc.fill_null(status, "?"), priority, ":")

    ruled = apply_arrow_rules(rows, [
        ArrowRule("digits", ["o_custkey"], "bigint", digit_sum),
        ArrowRule("label", ["o_orderstatus", "o_orderpriority"], "string", label, nulls="pass"),
    ])
    return ruled.select("o_orderkey", "digits", "label")
