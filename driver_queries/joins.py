"""Lookup joins, positional joins, row numbers, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, table
from tallymark.operators.checks import fanout_summary, join_fanout
from tallymark.operators.joins import lookup_join, positional_join
from tallymark.operators.rownumber import number_rows, number_within_keys
from tallymark.sources.servers import union_servers

_LOOKUP_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
    c_name, c_mktsegment AS segment FROM orders {how} JOIN customer ON o_custkey = c_custkey"""


def _lookup(spark, sf_dir, how):
    return lookup_join(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), [("o_custkey", "c_custkey")], how,
        {"c_name": "c_name", "c_mktsegment": "segment"},
    )


@query(_LOOKUP_SQL.format(how="LEFT"))
def lookup_left(spark, sf_dir):
    return _lookup(spark, sf_dir, "LEFT")


@query(_LOOKUP_SQL.format(how="INNER"))
def lookup_inner(spark, sf_dir):
    return _lookup(spark, sf_dir, "INNER")


_LABELS_SQL = """SELECT labels.doc_id, quality, toxic, documents.doc_id AS document, lang, n_chars
    FROM (SELECT doc_id * 2 AS doc_id, quality, toxic FROM labels) labels {how} JOIN documents ON labels.doc_id = documents.doc_id"""


def _labels(spark, sf_dir, how):
    """Labels looked up in the documents; the doubled ids leave rows without a partner on both sides."""
    labels = table(spark, sf_dir, "labels").withColumn("doc_id", F.col("doc_id") * 2)
    return lookup_join(
        labels, table(spark, sf_dir, "documents"), [("doc_id", "doc_id")], how,
        {"doc_id": "document", "lang": "lang", "n_chars": "n_chars"},
    )


@query(_LABELS_SQL.format(how="RIGHT"))
def lookup_right(spark, sf_dir):
    return _labels(spark, sf_dir, "RIGHT")


@query(_LABELS_SQL.format(how="FULL"))
def lookup_full(spark, sf_dir):
    return _labels(spark, sf_dir, "FULL")


@query("""SELECT a.conv_id, a.turn, a.role, a.text, b.role AS earlier_role FROM conversations a
    LEFT JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1""")
def lookup_composite(spark, sf_dir):
    """Each turn with the role of the turn before it: a two-column key."""
    turns = table(spark, sf_dir, "conversations")
    earlier = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("earlier_role"))
    return lookup_join(turns, earlier, [("conv_id", "conv_id"), ("turn", "turn")], "left", ["earlier_role"])


@query("""SELECT c.rn, c_custkey, c_name, p_partkey, p_name FROM
    (SELECT row_number() OVER (ORDER BY c_custkey) AS rn, c_custkey, c_name FROM customer) c
    JOIN (SELECT row_number() OVER (ORDER BY p_partkey) AS rn, p_partkey, p_name FROM part) p ON c.rn = p.rn""")
def positional_join_tables(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return positional_join(customer, [(part, ["p_partkey"])], ["c_custkey"])


@query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders")
def row_number_distributed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return number_rows(orders, ["o_orderkey"], unique=True)


_WITHIN_SQL = """SELECT o_custkey, o_orderkey,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders"""


@query(_WITHIN_SQL)
def row_number_within_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    numbered = number_within_keys(orders, ["o_custkey"], ["o_totalprice", "o_orderkey"])
    return numbered.select("o_custkey", "o_orderkey", "rn")


@query("""SELECT o_orderstatus, o_orderkey,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders""")
def row_number_within_hot_key(spark, sf_dir):
    """A few keys that hold everything: their rows are numbered across tasks."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey")
    return number_within_keys(orders, ["o_orderstatus"], ["o_orderkey"], hot_key_rows=100)


@query("""SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS o_orderpriority,
    's' || CAST(o_orderkey % 3 AS VARCHAR) AS _source_server FROM orders""")
def union_servers_by_name(spark, sf_dir):
    """Three servers; only one knows the priority, and one has its columns in another order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    of = {i: orders.filter(F.col("o_orderkey") % 3 == i) for i in range(3)}
    return union_servers({
        "s0": of[0].drop("o_orderpriority"),
        "s1": of[1],
        "s2": of[2].select("o_totalprice", "o_orderkey"),
    })


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, CAST(1 AS BIGINT) AS left_rows, coalesce(n, 0) AS right_rows,
    greatest(coalesce(n, 0), 1) AS joined_rows FROM orders LEFT JOIN l ON l_orderkey = o_orderkey""")
def join_fanout_by_key(spark, sf_dir):
    return join_fanout(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), [("o_orderkey", "l_orderkey")]
    )


@query("""WITH l AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT count(*) AS left_rows, CAST(sum(greatest(coalesce(n, 0), 1)) AS BIGINT) AS joined_rows,
    count(*) FILTER (n IS NULL) AS unmatched_rows, max(coalesce(n, 0)) AS widest
    FROM customer LEFT JOIN l ON o_custkey = c_custkey""")
def join_fanout_summary(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return fanout_summary(join_fanout(customer, orders, [("c_custkey", "o_custkey")]))


@query("""SELECT o_orderkey, CAST(o_custkey AS DECIMAL(21,2)) AS o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
    CASE WHEN o_orderkey % 3 = 1 THEN date_trunc('day', o_orderdate)::TIMESTAMP ELSE o_orderdate END AS o_orderdate,
    CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderkey % 100 AS VARCHAR) ELSE o_orderpriority END AS o_orderpriority,
    's' || CAST(o_orderkey % 3 AS VARCHAR) AS _source_server FROM orders""")
def union_servers_widened(spark, sf_dir):
    """Three servers that type their columns differently: whole, decimal and double numbers, days and times, text."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    of = {i: orders.filter(F.col("o_orderkey") % 3 == i) for i in range(3)}
    return union_servers({
        "s0": of[0].withColumn("o_custkey", F.col("o_custkey").cast("int")),
        "s1": of[1].withColumns({
            "o_custkey": F.col("o_custkey").cast("decimal(12,2)"), "o_orderdate": F.col("o_orderdate").cast("date"),
        }),
        "s2": of[2].withColumn("o_orderpriority", (F.col("o_orderkey") % 100).cast("int")),
    }, widen_types=True)
