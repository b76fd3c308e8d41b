"""Registration, table access, and pieces of oracle SQL that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query under its own name, with its oracle SQL."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- the injected target: orders with known differences ------------------------------

TARGET_SQL = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 0.5 ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderkey % 19 = 0 THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 17 <> 0
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 23 = 0
"""


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    changed = orders.filter(key % 17 != 0).select(
        key,
        "o_custkey",
        F.when(key % 29 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 13 == 0, F.col("o_totalprice") + 0.5).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(key % 19 == 0, F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")))
        .otherwise(F.col("o_orderpriority"))
        .alias("o_orderpriority"),
    )
    added = orders.filter(key % 23 == 0).withColumn("o_orderkey", key + F.lit(1000000000))
    return changed.unionByName(added)


# -- canonical text in the oracle's SQL ------------------------------------------------


def sql_number(c: str, scale: int = 6) -> str:
    return f"rtrim(rtrim(CAST(CAST(round({c}, {scale}) AS DECIMAL(38, {scale})) AS VARCHAR), '0'), '.')"


def sql_text(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('true', 'false') THEN lower(trim({c})) ELSE trim({c}) END"


def sql_plain(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


ORDER_TEXTS = {
    "o_custkey": sql_plain,
    "o_orderdate": sql_plain,
    "o_orderpriority": sql_text,
    "o_orderstatus": sql_text,
    "o_totalprice": sql_number,
}


def sql_diff(
    source: str,
    target: str,
    keys: list[str],
    texts: dict[str, Callable[[str], str]],
    server: str | None = None,
) -> str:
    """Cell-level differences of two queries, matched on keys that may be NULL."""
    tag = f", {server}" if server else ""
    columns = ", ".join([*keys, *(f"{fn(c)} AS {c}" for c, fn in texts.items())])
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)

    def pk(side: str) -> str:
        return " || '|' || ".join(f"coalesce(CAST({side}.{k} AS VARCHAR), '')" for k in keys)

    owner = f"s.{server}" if server else "'UNKNOWN'"
    cells = " UNION ALL ".join(
        f"""SELECT {pk('s')} AS primary_key_value, {owner} AS source_server, '{c}' AS column_name,
        s.{c} AS expected_value, t.{c} AS actual_value, 'VALUE_MISMATCH' AS diff_type
        FROM s JOIN t ON {on} WHERE s.{c} IS DISTINCT FROM t.{c}"""
        for c in texts
    )
    return f"""WITH s AS (SELECT {columns}{tag} FROM ({source}) q), t AS (SELECT {columns} FROM ({target}) q)
    SELECT {pk('s')} AS primary_key_value, {owner} AS source_server, '<ENTIRE_ROW>' AS column_name,
        '<PRESENT_IN_SOURCE>' AS expected_value, '<MISSING_IN_TARGET>' AS actual_value, 'MISSING_IN_TARGET' AS diff_type
    FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {on})
    UNION ALL
    SELECT {pk('t')}, 'N/A', '<ENTIRE_ROW>', '<EXTRA_IN_TARGET>', '<PRESENT_IN_TARGET>', 'EXTRA_IN_TARGET'
    FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {on})
    UNION ALL {cells}"""


ORDERS_DIFF_SQL = sql_diff("SELECT * FROM orders", TARGET_SQL, ["o_orderkey"], ORDER_TEXTS)
