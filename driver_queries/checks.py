"""Filters, aggregates and data checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from driver_queries.registry import TARGET_SQL, orders_target, query, table
from tallymark.operators.aggregates import group_rule
from tallymark.operators.checks import conformance, key_uniqueness, null_check, row_count_check, table_checks
from tallymark.operators.filters import date_window, pk_filter, preview, where
from tallymark.sources.jdbc import partition_bounds, scan_predicates
from tallymark.sources.scratch import stash
from tallymark.spec import DeclaredColumn


@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31'")
def date_range(spark, sf_dir):
    return date_window(
        table(spark, sf_dir, "orders"), "range", "1995-01-01", "O_ORDERDATE", "1996-12-31", "o_orderdate"
    )


@query("SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def date_open(spark, sf_dir):
    """Only a lower bound."""
    kept = date_window(table(spark, sf_dir, "events"), "range", "2024-01-10", "ts")
    return kept.select("event_id", "user_id", "event_type", "value")


@query("SELECT event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-16'")
def date_whole_day(spark, sf_dir):
    """The last day counts to its end."""
    events = table(spark, sf_dir, "events")
    return date_window(events, "range", date_to="2024-01-15", to_col="ts", inclusive_day=True).select("event_id", "value")


@query("SELECT * FROM orders")
def date_full(spark, sf_dir):
    return date_window(table(spark, sf_dir, "orders"), "full", "1995-01-01", "o_orderdate")


@query("SELECT * FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R'")
def where_pushed(spark, sf_dir):
    return where(table(spark, sf_dir, "lineitem"), "l_quantity > 30 and l_returnflag = 'R'")


@query("SELECT * FROM lineitem WHERE l_partkey BETWEEN 100 AND 1500")
def pk_range(spark, sf_dir):
    return pk_filter(table(spark, sf_dir, "lineitem"), "l_partkey", "range", 100, 1500)


@query("SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def pk_set(spark, sf_dir):
    """The set is a table: the documents that have a label."""
    return pk_filter(table(spark, sf_dir, "documents"), "doc_id", "set", values=table(spark, sf_dir, "labels"))


@query("SELECT min(l_orderkey) AS lower_bound, max(l_orderkey) AS upper_bound FROM lineitem")
def scan_bounds(spark, sf_dir):
    return partition_bounds(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS total, count(l_partkey) AS lines,
    avg(l_quantity) AS mean, min(l_shipdate) AS first_day, max(l_extendedprice) AS dearest
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_rules(spark, sf_dir):
    return group_rule(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "total": ("sum", "l_quantity"),
        "lines": ("count", "l_partkey"),
        "mean": ("avg", "l_quantity"),
        "first_day": ("min", "l_shipdate"),
        "dearest": ("max", "l_extendedprice"),
    })


@query("""SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def key_duplicates(spark, sf_dir):
    return key_uniqueness(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_NULLS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM t"
    for c in ("o_orderkey", "o_orderstatus", "o_totalprice")
)


@query(f"WITH t AS ({TARGET_SQL}) {_NULLS_SQL}")
def null_check_counts(spark, sf_dir):
    return null_check(orders_target(spark, sf_dir), ["o_orderkey", "O_ORDERSTATUS", "o_totalprice"]).replace(
        {"O_ORDERSTATUS": "o_orderstatus"}, subset="column_name"
    )


@query(f"""WITH n AS (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM ({TARGET_SQL}) t) AS b)
    SELECT 'source' AS stage, a AS row_count, TRUE AS matches FROM n
    UNION ALL SELECT 'target', b, a = b FROM n""")
def row_counts(spark, sf_dir):
    return row_count_check({"source": table(spark, sf_dir, "orders"), "target": orders_target(spark, sf_dir)})


@query("""WITH n AS (SELECT
      count(*) FILTER (length(text) > 2000) AS long_text, count(*) FILTER (length(source) > 5) AS long_source,
      count(*) FILTER (TRY_CAST(lang AS INTEGER) IS NULL) AS bad_lang FROM documents)
    SELECT 'text' AS column_name, 'TOO_LONG' AS issue, 'VARCHAR(2000)' AS declared_type, 'VARCHAR' AS actual_type,
      long_text AS bad_rows FROM n WHERE long_text > 0
    UNION ALL SELECT 'source', 'TOO_LONG', 'CHAR(5)', 'VARCHAR', long_source FROM n WHERE long_source > 0
    UNION ALL SELECT 'lang', 'TYPE_MISMATCH', 'INT', 'VARCHAR', NULL
    UNION ALL SELECT 'lang', 'BAD_VALUE', 'INT', 'VARCHAR', bad_lang FROM n WHERE bad_lang > 0
    UNION ALL SELECT 'title', 'MISSING_COLUMN', 'VARCHAR(80)', NULL, NULL
    UNION ALL SELECT 'n_chars', 'EXTRA_COLUMN', NULL, 'BIGINT', NULL""")
def conformance_rows(spark, sf_dir):
    return conformance(table(spark, sf_dir, "documents"), [
        DeclaredColumn("doc_id", "BIGINT", nullable=False),
        DeclaredColumn("text", "VARCHAR(2000)", nullable=False),
        DeclaredColumn("source", "CHAR(5)"),
        DeclaredColumn("lang", "INT"),
        DeclaredColumn("title", "VARCHAR(80)"),
    ])


@query(f"""WITH t AS ({TARGET_SQL}), n AS (SELECT count(*) FILTER (o_orderstatus IS NULL) AS nulls,
      count(*) FILTER (abs(o_totalprice) >= 100000) AS wide,
      count(*) FILTER (length(o_orderpriority) > 15) AS long FROM t)
    SELECT 'o_orderstatus' AS column_name, 'NULL_VALUE' AS issue, 'VARCHAR(1)' AS declared_type, 'VARCHAR' AS actual_type,
      nulls AS bad_rows FROM n WHERE nulls > 0
    UNION ALL SELECT 'o_totalprice', 'TYPE_MISMATCH', 'DECIMAL(7,2)', 'DOUBLE', NULL
    UNION ALL SELECT 'o_totalprice', 'BAD_VALUE', 'DECIMAL(7,2)', 'DOUBLE', wide FROM n WHERE wide > 0
    UNION ALL SELECT 'o_orderpriority', 'TOO_LONG', 'VARCHAR(15)', 'VARCHAR', long FROM n WHERE long > 0""")
def conformance_partial(spark, sf_dir):
    """Only the declared columns are looked at."""
    return conformance(orders_target(spark, sf_dir), [
        DeclaredColumn("o_orderkey", "BIGINT", nullable=False),
        DeclaredColumn("o_orderstatus", "VARCHAR(1)", nullable=False),
        DeclaredColumn("o_totalprice", "DECIMAL(7,2)"),
        DeclaredColumn("o_orderpriority", "VARCHAR(15)"),
    ], mode="partial")


@query("SELECT 5::BIGINT AS shown, 5::BIGINT AS known")
def preview_rows(spark, sf_dir):
    """How many rows a preview shows, and how many of them are rows of the table."""
    orders = table(spark, sf_dir, "orders")
    shown = stash(preview(orders), "preview")
    same = [shown[c].eqNullSafe(orders[c]) for c in orders.columns]
    known = shown.join(orders, reduce(Column.__and__, same), "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("shown")).crossJoin(known.agg(F.count(F.lit(1)).alias("known")))


@query("""SELECT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey <= 3000""")
def pk_set_values(spark, sf_dir):
    """Thousands of values, as text, against a whole-number key."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return pk_filter(lines, "l_orderkey", "set", values=[str(k) for k in range(3001)])


@query("""WITH n AS (SELECT count_if(o_orderkey % 3 = 0) AS far, count_if(o_orderkey % 3 = 1) AS part FROM orders)
    SELECT 'whole' AS column_name, 'BAD_VALUE' AS issue, 'INT' AS declared_type, 'VARCHAR' AS actual_type, far + part AS bad_rows FROM n
    UNION ALL SELECT 'broken', 'BAD_VALUE', 'INT', 'DOUBLE', far + part FROM n
    UNION ALL SELECT 'whole', 'TYPE_MISMATCH', 'INT', 'VARCHAR', NULL
    UNION ALL SELECT 'broken', 'TYPE_MISMATCH', 'INT', 'DOUBLE', NULL""")
def conformance_integers(spark, sf_dir):
    """Values out of an INT's range, or with a fraction, as text and as doubles."""
    key = F.col("o_orderkey")
    text = F.when(key % 3 == 0, "3000000000").when(key % 3 == 1, "1.7").otherwise("12.0")
    number = F.when(key % 3 == 0, 3e9).when(key % 3 == 1, 2.7).otherwise(12.0)
    orders = table(spark, sf_dir, "orders").select(text.alias("whole"), number.alias("broken"))
    return conformance(orders, [DeclaredColumn("whole", "INT"), DeclaredColumn("broken", "INT")], mode="partial")


_LONG_TEXT = """'12345678901234567890' || lpad(CAST(o_orderkey AS VARCHAR), 18, '0') || CASE WHEN o_orderkey % 5 = 0 THEN '.5'
    WHEN o_orderkey % 7 = 0 THEN '1' WHEN o_orderkey % 3 = 0 THEN '.000' ELSE '' END"""


@query(f"""WITH t AS (SELECT {_LONG_TEXT} AS n, o_orderkey FROM orders),
    bad AS (SELECT count(*) FILTER (n LIKE '%.5' OR length(n) = 39) AS wide,
      count(*) FILTER (o_orderkey % 11 = 0) AS fraction FROM t)
    SELECT 'n' AS column_name, 'TYPE_MISMATCH' AS issue, 'NUMBER(38,0)' AS declared_type, 'VARCHAR' AS actual_type, NULL::BIGINT AS bad_rows
    UNION ALL SELECT 'n', 'BAD_VALUE', 'NUMBER(38,0)', 'VARCHAR', wide FROM bad
    UNION ALL SELECT 'm', 'TYPE_MISMATCH', 'NUMBER(30,8)', 'VARCHAR', NULL
    UNION ALL SELECT 'm', 'BAD_VALUE', 'NUMBER(30,8)', 'VARCHAR', fraction FROM bad""")
def conformance_long_numbers(spark, sf_dir):
    """Text of up to 39 digits, with and without a fraction, declared as numbers."""
    key = F.col("o_orderkey")
    digits = F.concat(F.lit("12345678901234567890"), F.lpad(key.cast("string"), 18, "0"))
    long = F.concat(digits, F.when(key % 5 == 0, ".5").when(key % 7 == 0, "1").when(key % 3 == 0, ".000").otherwise(""))
    places = F.concat(F.substring(digits, 1, 21), F.lit(".12345678"), F.when(key % 11 == 0, "9").otherwise("00"))
    rows = table(spark, sf_dir, "orders").select(long.alias("n"), places.alias("m"))
    return conformance(rows, [DeclaredColumn("n", "NUMBER(38,0)"), DeclaredColumn("m", "NUMBER(30,8)")])


@query("SELECT count(*) AS row_count, 8::BIGINT AS scans, true AS balanced, count(*) FILTER (o_orderkey % 20 = 0) AS null_rows FROM orders")
def scan_predicates_balanced(spark, sf_dir):
    """A column with gaps, skew and NULLs parted into scans: every row meets one condition, all scans are of like size."""
    key, modulus = F.col("o_orderkey"), F.lit(1000003).cast("bigint")
    rest = key % modulus
    # a cube's remainder, taken at each step: the cube of a key past 2,097,151 is no bigint
    rows = table(spark, sf_dir, "orders").select(F.when(key % 20 > 0, rest * rest % modulus * rest % modulus).alias("k"))
    predicates = scan_predicates(rows, "K", 8)
    met = rows.select("k", F.explode(F.array(*[
        F.when(F.coalesce(F.expr(p), F.lit(False)), F.lit(i)) for i, p in enumerate(predicates)
    ])).alias("scan")).filter("scan is not null")
    sizes = met.groupBy("scan").agg(
        F.count(F.lit(1)).alias("n"), F.count("k").alias("known"), F.count_if(F.col("k").isNull()).alias("nulls")
    )
    return sizes.agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("scans"),
        (F.max("known") <= 1.1 * F.min("known")).alias("balanced"), F.sum("nulls").alias("null_rows"),
    )


@query(f"""WITH t AS ({TARGET_SQL}), k AS (SELECT o_custkey, count(*) AS n FROM t GROUP BY o_custkey)
    SELECT 'ROW_COUNT' AS "check", NULL AS column_name, NULL AS detail, count(*)::VARCHAR AS value FROM t
    UNION ALL SELECT 'NULLS', 'o_orderstatus', NULL, count(*) FILTER (o_orderstatus IS NULL)::VARCHAR FROM t
    UNION ALL SELECT 'NULLS', 'o_orderkey', NULL, count(*) FILTER (o_orderkey IS NULL)::VARCHAR FROM t
    UNION ALL SELECT 'KEYS', 'o_custkey', NULL, count(*)::VARCHAR FROM k
    UNION ALL SELECT 'DUPLICATE_KEYS', 'o_custkey', NULL, count(*) FILTER (n > 1)::VARCHAR FROM k
    UNION ALL SELECT 'WIDEST_KEY', 'o_custkey', NULL, max(n)::VARCHAR FROM k
    UNION ALL SELECT 'LEAST', 'o_orderkey', NULL, min(o_orderkey)::VARCHAR FROM t
    UNION ALL SELECT 'GREATEST', 'o_orderkey', NULL, max(o_orderkey)::VARCHAR FROM t
    UNION ALL SELECT 'NULL_VALUE', 'o_orderstatus', 'VARCHAR(1) / VARCHAR', count(*) FILTER (o_orderstatus IS NULL)::VARCHAR FROM t
    UNION ALL SELECT 'TYPE_MISMATCH', 'o_totalprice', 'DECIMAL(7,2) / DOUBLE', NULL
    UNION ALL SELECT 'BAD_VALUE', 'o_totalprice', 'DECIMAL(7,2) / DOUBLE', count(*) FILTER (abs(o_totalprice) >= 100000)::VARCHAR FROM t
    UNION ALL SELECT 'TOO_LONG', 'o_orderpriority', 'VARCHAR(15) / VARCHAR', count(*) FILTER (length(o_orderpriority) > 15)::VARCHAR FROM t""")
def table_checks_fused(spark, sf_dir):
    """Row count, NULLs, key, bounds and declared types of one table in one scan."""
    return table_checks(
        orders_target(spark, sf_dir), required=["o_orderstatus", "O_ORDERKEY"], keys=["o_custkey"], bounds=["o_orderkey"],
        declared=[
            DeclaredColumn("o_orderkey", "BIGINT", nullable=False), DeclaredColumn("o_orderstatus", "VARCHAR(1)", nullable=False),
            DeclaredColumn("o_totalprice", "DECIMAL(7,2)"), DeclaredColumn("o_orderpriority", "VARCHAR(15)"),
        ],
        mode="partial",
    )
