"""Comparison, its parts and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    ORDER_TEXTS,
    ORDERS_DIFF_SQL,
    TARGET_SQL,
    orders_target,
    query,
    sql_diff,
    sql_number,
    sql_plain,
    sql_text,
    table,
)
from tallymark.functions.canonical import comparison_scales, normalise
from tallymark.operators.keys import keys_in, keys_not_in
from tallymark.operators.rownumber import number_within_keys
from tallymark.plans.reconcile import prepare, recon_counts, reconcile, slim_pairs
from tallymark.plans.report import diff_by_column, records_by_type, summarize, top_columns
from tallymark.sources.scratch import stash
from tallymark.sources.servers import union_servers

_COUNTS_SQL = f"""WITH s AS (SELECT * FROM orders), t AS ({TARGET_SQL}), j AS (
    SELECT s.o_orderkey IS NOT NULL AS in_s, t.o_orderkey IS NOT NULL AS in_t,
        NOT (s.o_custkey IS NOT DISTINCT FROM t.o_custkey AND s.o_orderdate IS NOT DISTINCT FROM t.o_orderdate
        AND trim(s.o_orderpriority) IS NOT DISTINCT FROM trim(t.o_orderpriority)
        AND trim(s.o_orderstatus) IS NOT DISTINCT FROM trim(t.o_orderstatus)
        AND {sql_number('s.o_totalprice')} IS NOT DISTINCT FROM {sql_number('t.o_totalprice')}) AS differs
    FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey),
  c AS (SELECT count(*) FILTER (in_s) AS source_rows, count(*) FILTER (in_t) AS target_rows,
    count(*) FILTER (in_s AND in_t AND NOT differs) AS matched_rows,
    count(*) FILTER (in_s AND NOT in_t) AS missing_rows, count(*) FILTER (in_t AND NOT in_s) AS extra_rows,
    count(*) FILTER (in_s AND in_t AND differs) AS mismatched_rows FROM j)
"""


@query(_COUNTS_SQL + """SELECT *, missing_rows + extra_rows + mismatched_rows AS diff_rows,
    CAST(0 AS BIGINT) AS duplicate_keys FROM c""")
def recon_counts_orders(spark, sf_dir):
    return recon_counts(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"])


def _orders_result(spark, sf_dir, method="hash"):
    source, target = table(spark, sf_dir, "orders"), orders_target(spark, sf_dir)
    return reconcile(source, target, ["o_orderkey"], method=method)


@query(ORDERS_DIFF_SQL)
def recon_diff_orders_full(spark, sf_dir):
    return _orders_result(spark, sf_dir, "full").diff


@query(ORDERS_DIFF_SQL)
def recon_diff_orders_hash(spark, sf_dir):
    return _orders_result(spark, sf_dir, "hash").diff


@query(ORDERS_DIFF_SQL)
def recon_diff_orders_anti(spark, sf_dir):
    return _orders_result(spark, sf_dir, "anti").diff


_TURNS_TARGET_SQL = """SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN upper(role) ELSE role END AS role,
    CASE WHEN (conv_id + turn) % 11 = 0 THEN text || '!' ELSE text END AS text
    FROM conversations WHERE (conv_id + turn) % 17 <> 0"""


@query(sql_diff("SELECT * FROM conversations", _TURNS_TARGET_SQL, ["conv_id", "turn"],
                {"role": sql_text, "text": sql_text}))
def recon_diff_composite(spark, sf_dir):
    source = table(spark, sf_dir, "conversations")
    mixed = F.col("conv_id") + F.col("turn")
    target = source.filter(mixed % 17 != 0).select(
        "conv_id",
        "turn",
        F.when(F.col("turn") % 3 == 1, F.upper("role")).otherwise(F.col("role")).alias("role"),
        F.when(mixed % 11 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"),
    )
    return reconcile(source, target, ["conv_id", "turn"]).diff


@query(sql_diff(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS a, o_orderpriority AS b FROM orders",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority ELSE o_orderstatus END AS a,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS b FROM orders""",
    ["o_orderkey"], {"a": sql_text, "b": sql_text}))
def recon_null_shift(spark, sf_dir):
    """A value and a NULL change places: the row hash must tell them apart."""
    orders = table(spark, sf_dir, "orders")
    moved = F.col("o_orderkey") % 5 == 0
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    source = orders.select("o_orderkey", F.when(~moved, status).alias("a"), priority.alias("b"))
    target = orders.select(
        "o_orderkey", F.when(moved, priority).otherwise(status).alias("a"), F.when(~moved, priority).alias("b")
    )
    return reconcile(source, target, ["o_orderkey"]).diff


_NULL_STATUS_SQL = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 29 <> 0 THEN o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority FROM orders"""


@query(sql_diff(_NULL_STATUS_SQL, TARGET_SQL, ["o_orderstatus", "o_orderkey"],
                {c: fn for c, fn in ORDER_TEXTS.items() if c != "o_orderstatus"}))
def recon_null_key(spark, sf_dir):
    """The first part of the key is NULL in some rows of both sides; those rows still meet."""
    source = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 29 != 0, F.col("o_orderstatus"))
    )
    return reconcile(source, orders_target(spark, sf_dir), ["o_orderstatus", "o_orderkey"]).diff


@query("""SELECT count(*) AS source_rows, count(*) AS target_rows, count(*) AS matched_rows,
    CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows, CAST(0 AS BIGINT) AS mismatched_rows,
    CAST(0 AS BIGINT) AS diff_rows, CAST(0 AS BIGINT) AS diff_cells, 'PASS' AS verdict, 0 AS exit_code FROM orders""")
def recon_self_pass(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    result = reconcile(orders, orders, ["o_orderkey"])
    return summarize(result.diff, result.counts)


@query(f"SELECT diff_type, count(DISTINCT primary_key_value) AS record_count FROM ({ORDERS_DIFF_SQL}) d GROUP BY diff_type")
def recon_diff_by_type(spark, sf_dir):
    return records_by_type(_orders_result(spark, sf_dir))


@query(f"SELECT column_name, count(*) AS diff_count FROM ({ORDERS_DIFF_SQL}) d GROUP BY column_name")
def recon_diff_by_column(spark, sf_dir):
    return diff_by_column(_orders_result(spark, sf_dir).diff)


@query(f"""SELECT column_name, count(*) AS diff_count FROM ({ORDERS_DIFF_SQL}) d GROUP BY column_name
    ORDER BY diff_count DESC, column_name LIMIT 2""")
def recon_top_columns(spark, sf_dir):
    return top_columns(_orders_result(spark, sf_dir).diff, 2)


@query(_COUNTS_SQL + f"""SELECT *, missing_rows + extra_rows + mismatched_rows AS diff_rows,
    (SELECT count(*) FROM ({ORDERS_DIFF_SQL}) d) AS diff_cells,
    CASE WHEN missing_rows + extra_rows + mismatched_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
    CASE WHEN missing_rows + extra_rows + mismatched_rows = 0 THEN 0 ELSE 3 END AS exit_code FROM c""")
def recon_summary(spark, sf_dir):
    result = _orders_result(spark, sf_dir)
    return summarize(result.diff, result.counts)


@query(f"""SELECT p_partkey, {sql_text('p_name')} AS p_name, {sql_plain('p_size')} AS p_size,
    {sql_number('p_retailprice')} AS p_retailprice FROM part""")
def normalise_values(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    columns = ["p_name", "p_size", "p_retailprice"]
    return normalise(part, columns, comparison_scales(part.schema, part.schema, columns), keep=["p_partkey"])


@query(f"""SELECT c_custkey, {sql_text('c_name')} AS c_name, {sql_number('c_acctbal', 2)} AS c_acctbal,
    {sql_text('c_mktsegment')} AS c_mktsegment FROM customer""")
def normalise_to_decimal_scale(spark, sf_dir):
    """A double that faces a decimal is rounded to the decimal's places."""
    customer = table(spark, sf_dir, "customer")
    facing = customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    columns = ["c_name", "c_acctbal", "c_mktsegment"]
    return normalise(customer, columns, comparison_scales(customer.schema, facing.schema, columns), keep=["c_custkey"])


_TEXT_TARGET_SQL = f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM ({TARGET_SQL}) x"""


@query(sql_diff("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, * EXCLUDE (o_orderkey) FROM orders",
                _TEXT_TARGET_SQL, ["o_orderkey"],
                {**ORDER_TEXTS, "o_totalprice": lambda c: sql_number(c, 2)}))
def recon_cross_types(spark, sf_dir):
    """Keys and foreign keys as text, prices as text with two places, against numbers."""
    price = F.round("o_totalprice", 2).cast("decimal(18,2)")
    target = orders_target(spark, sf_dir).select(
        F.col("o_orderkey").cast("string"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.concat(price.cast("string"), F.lit("0 ")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    source = table(spark, sf_dir, "orders").withColumn("o_totalprice", price)
    return reconcile(source, target, ["o_orderkey"]).diff


@query(f"""WITH t AS ({TARGET_SQL}) SELECT CAST(s.o_orderkey AS BIGINT) AS o_orderkey FROM orders s JOIN t ON s.o_orderkey = t.o_orderkey
    WHERE trim(s.o_orderstatus) IS DISTINCT FROM trim(t.o_orderstatus)
       OR trim(s.o_orderpriority) IS DISTINCT FROM trim(t.o_orderpriority)
       OR s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_orderdate IS DISTINCT FROM t.o_orderdate
       OR {sql_number('s.o_totalprice')} IS DISTINCT FROM {sql_number('t.o_totalprice')}""")
def slim_hash_mismatch_keys(spark, sf_dir):
    sides = prepare(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"])
    pairs = slim_pairs(sides)
    return pairs.filter("src_rows = 1 and tgt_rows = 1 and hash_xor <> 0").select("o_orderkey")


@query(f"SELECT * FROM orders s WHERE NOT EXISTS (SELECT 1 FROM ({TARGET_SQL}) t WHERE t.o_orderkey = s.o_orderkey)")
def anti_missing(spark, sf_dir):
    return keys_not_in(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"])


@query(f"SELECT * FROM ({TARGET_SQL}) t WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE t.o_orderkey = s.o_orderkey)")
def anti_extra(spark, sf_dir):
    return keys_not_in(orders_target(spark, sf_dir), table(spark, sf_dir, "orders"), ["o_orderkey"])


@query(f"SELECT * FROM orders s WHERE EXISTS (SELECT 1 FROM ({TARGET_SQL}) t WHERE t.o_orderkey = s.o_orderkey)")
def semi_present(spark, sf_dir):
    return keys_in(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"])


_LINES_TARGET_SQL = """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_partkey % 13 = 0 THEN l_quantity + 100 ELSE l_quantity END AS l_quantity, l_extendedprice, l_discount,
    CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag, l_shipdate
    FROM lineitem WHERE l_suppkey % 17 <> 0"""


def _ordinal_sql() -> str:
    texts = {
        "l_discount": sql_number, "l_extendedprice": sql_number, "l_partkey": sql_plain,
        "l_quantity": sql_number, "l_returnflag": sql_text, "l_shipdate": sql_plain,
    }
    order = ", ".join(f"{c} NULLS FIRST" for c in texts)
    numbered = """SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS ordinal
        FROM ({rows}) z"""
    columns = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_shipdate"
    source = numbered.format(order=order, rows=f"SELECT {columns} FROM lineitem")
    target = numbered.format(order=order, rows=_LINES_TARGET_SQL)
    diff = sql_diff(source, target, ["l_orderkey", "l_linenumber", "ordinal"], texts)
    return f"SELECT * REPLACE (regexp_replace(primary_key_value, '\\|\\d+$', '') AS primary_key_value) FROM ({diff}) d"


@query(_ordinal_sql())
def recon_duplicates_ordinal(spark, sf_dir):
    """A key that is not unique: its rows are paired in order."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_shipdate",
    )
    quantity = F.col("l_quantity")
    target = lines.filter(F.col("l_suppkey") % 17 != 0).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_partkey") % 13 == 0, quantity + 100).otherwise(quantity).alias("l_quantity"),
        "l_extendedprice", "l_discount",
        F.when(F.col("l_suppkey") % 7 != 0, F.col("l_returnflag")).alias("l_returnflag"), "l_shipdate",
    )
    return reconcile(lines, target, ["l_orderkey", "l_linenumber"], on_duplicate="ordinal").diff


@query(sql_diff("SELECT *, 's' || CAST(o_orderkey % 3 AS VARCHAR) AS server FROM orders", TARGET_SQL,
                ["o_orderkey"], ORDER_TEXTS, server="server"))
def recon_multi_server(spark, sf_dir):
    """The orders of three servers, united, against one target; each difference names its server."""
    orders = table(spark, sf_dir, "orders")
    servers = {f"s{i}": orders.filter(F.col("o_orderkey") % 3 == i) for i in range(3)}
    return reconcile(union_servers(servers), orders_target(spark, sf_dir), ["O_ORDERKEY"]).diff


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS primary_key_value, 'UNKNOWN' AS source_server, 'd' AS column_name,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00' AS expected_value,
    CAST(o_orderdate + INTERVAL 1 HOUR AS VARCHAR) AS actual_value, 'VALUE_MISMATCH' AS diff_type
    FROM orders WHERE o_orderkey % 10 = 0""")
def recon_dates_promoted(spark, sf_dir):
    """A date against a timestamp: equal at midnight once both are timestamps."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    source = orders.select("o_orderkey", day.cast("date").alias("d"))
    target = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 == 0, day + F.expr("INTERVAL 1 HOUR")).otherwise(day).alias("d"),
    )
    return reconcile(source, target, ["o_orderkey"], temporal="promote").diff


_FORCED_SQL = """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'abc' ELSE o_custkey::VARCHAR || '.0' END AS v FROM orders),
     t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 2 = 0 THEN 'xyz' WHEN o_orderkey % 5 = 0 THEN ' abc '
                                   WHEN o_orderkey % 7 = 0 THEN (o_custkey + 1)::VARCHAR ELSE ' ' || o_custkey END AS v FROM orders)
SELECT count(*) AS differing FROM s JOIN t USING (o_orderkey)
WHERE coalesce(TRY_CAST(trim(replace(s.v, '.0', '')) AS BIGINT)::VARCHAR, trim(s.v))
   <> coalesce(TRY_CAST(trim(t.v) AS BIGINT)::VARCHAR, trim(t.v))
"""


@query(_FORCED_SQL)
def recon_forced_types(spark, sf_dir):
    """Text compared as whole numbers; what is no number on either side is compared as it is."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    number = F.col("o_custkey").cast("string")
    source = orders.select(key, F.when(key % 5 == 0, "abc").otherwise(F.concat(number, F.lit(".0"))).alias("v"))
    target = orders.select(
        key,
        F.when((key % 5 == 0) & (key % 2 == 0), "xyz").when(key % 5 == 0, " abc ")
        .when(key % 7 == 0, (F.col("o_custkey") + 1).cast("string")).otherwise(F.concat(F.lit(" "), number)).alias("v"),
    )
    result = reconcile(source, target, ["o_orderkey"], force_types={"v": "bigint"})
    return spark.createDataFrame([(result.counts.mismatched_rows,)], "differing bigint")


@query("""SELECT count(*) AS matched_rows, count(*) FILTER (WHERE o_orderkey % 9 = 0) AS mismatched_rows FROM orders""")
def recon_decimal_widths(spark, sf_dir):
    """DECIMAL(12,2) against DECIMAL(18,2), and a DECIMAL(20,3) against a whole number; twice, with and without differences."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    price, customer = F.col("o_totalprice"), F.col("o_custkey")
    source = orders.select(key, price.cast("decimal(12,2)").alias("p"), customer.cast("decimal(20,3)").alias("c"))
    same = orders.select(key, price.cast("decimal(18,2)").alias("p"), customer.alias("c"))
    other = same.withColumn("p", F.when(key % 9 == 0, F.col("p") + F.lit(1).cast("decimal(2,0)")).otherwise(F.col("p")).cast("decimal(18,2)"))
    equal, unequal = (reconcile(source, target, ["o_orderkey"]).counts for target in (same, other))
    return spark.createDataFrame([(equal.matched_rows, unequal.mismatched_rows)], "matched_rows bigint, mismatched_rows bigint")


@query("SELECT 's1' AS source_server, 'MISSING_IN_TARGET' AS diff_type, count(*) AS n FROM orders")
def recon_ordinal_servers(spark, sf_dir):
    """The same rows from two servers, and once in the target: the later server's are missing."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    source = union_servers({"s1": orders, "s0": orders})
    diff = reconcile(source, orders, ["o_orderkey"], on_duplicate="ordinal").diff
    return diff.groupBy("source_server", "diff_type").agg(F.count(F.lit(1)).alias("n"))


@query(ORDERS_DIFF_SQL)
def recon_diff_orders_digest(spark, sf_dir):
    return _orders_result(spark, sf_dir, "digest").diff


@query("""SELECT count(*) AS source_rows, count(*) AS target_rows, count(*) AS matched_rows, 0::BIGINT AS missing_rows,
    0::BIGINT AS extra_rows, 0::BIGINT AS mismatched_rows, 0::BIGINT AS diff_rows FROM lineitem""")
def recon_digest_self(spark, sf_dir):
    """Equal tables whose key is not unique: told from bucket digests alone."""
    lines = table(spark, sf_dir, "lineitem")
    return reconcile(lines, lines, ["l_orderkey", "l_linenumber"], method="digest").counts_frame()


_CANCEL_TARGET = """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate,
    CASE WHEN nth = 1 AND l_orderkey % 6 = 0 THEN l_discount + 1 ELSE l_discount END AS l_discount
    FROM lines WHERE NOT (nth = 1 AND l_orderkey % 10 = 5)"""

_CANCEL_SQL = f"""
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, l_discount, 
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_shipdate, l_discount) AS nth
  FROM lineitem),
target AS ({_CANCEL_TARGET}),
held AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, l_discount, sum(s) AS s, sum(t) AS t
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, l_discount, 1 AS s, 0 AS t FROM lines
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, l_discount, 0, 1 FROM target)
  GROUP BY ALL),
per_key AS (
  SELECT l_orderkey, sum(s) AS s, sum(t) AS t, sum(least(s, t)) AS matched,
         sum(greatest(s - t, 0)) AS s_left, sum(greatest(t - s, 0)) AS t_left
  FROM held GROUP BY l_orderkey)
SELECT sum(s)::BIGINT AS source_rows, sum(t)::BIGINT AS target_rows, sum(matched)::BIGINT AS matched_rows,
       sum(greatest(s_left - t_left, 0))::BIGINT AS missing_rows, sum(greatest(t_left - s_left, 0))::BIGINT AS extra_rows,
       sum(least(s_left, t_left))::BIGINT AS mismatched_rows,
       sum(greatest(s_left, t_left))::BIGINT AS diff_rows
FROM per_key"""


def _cancel_sides(spark, sf_dir):
    """Lines under their order alone: the first line of some orders is changed, of others it is gone."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate", "l_discount"
    )
    numbered = number_within_keys(lines, ["l_orderkey"], lines.columns[1:], "nth")
    order, first = F.col("l_orderkey"), F.col("nth") == 1
    target = numbered.filter(~(first & (order % 10 == 5))).withColumn(
        "l_discount", F.when(first & (order % 6 == 0), F.col("l_discount") + 1).otherwise(F.col("l_discount"))
    )
    # a comparison reads its sides several times, and numbering sorts the whole table
    return lines, stash(target.select(*lines.columns), "lines")


@query(_CANCEL_SQL)
def recon_cancel_counts(spark, sf_dir):
    """Repeated keys: equal rows match in whatever order they come, so a changed or absent row is one difference."""
    lines, target = _cancel_sides(spark, sf_dir)
    return reconcile(lines, target, ["l_orderkey"], on_duplicate="cancel").counts_frame()


@query(_CANCEL_SQL.split("held AS")[0].rstrip().rstrip(",") + f"""
SELECT CAST(s.l_orderkey AS VARCHAR) AS primary_key_value, 'UNKNOWN' AS source_server, 'l_discount' AS column_name,
       {sql_number('s.l_discount')} AS expected_value, {sql_number('s.l_discount + 1')} AS actual_value, 'VALUE_MISMATCH' AS diff_type
FROM lines s WHERE nth = 1 AND l_orderkey % 6 = 0 AND l_orderkey % 10 <> 5
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), 'UNKNOWN', '<ENTIRE_ROW>', '<PRESENT_IN_SOURCE>', '<MISSING_IN_TARGET>', 'MISSING_IN_TARGET'
FROM lines WHERE nth = 1 AND l_orderkey % 10 = 5""")
def recon_duplicates_cancel(spark, sf_dir):
    """The cells of the same comparison: the changed line is paired with its former self."""
    lines, target = _cancel_sides(spark, sf_dir)
    return reconcile(lines, target, ["l_orderkey"], on_duplicate="cancel", method="digest").diff
