"""Sources, sinks and a whole validation run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from driver_queries.mapping import order_map
from driver_queries.registry import (
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
from tallymark.operators.mapping import apply_mapping
from tallymark.plans.reconcile import reconcile
from tallymark.plans.report import compare_and_report, write_report
from tallymark.plans.validation import ValidationJob, run_validation
from tallymark.sources.files import KeyRange, read_csv, read_diff, schema_path, write_csv
from tallymark.sources.scratch import scratch_path
from tallymark.sources.servers import extract_servers, load_servers, union_servers
from tallymark.spec import ServerSource


@query(TARGET_SQL)
def csv_roundtrip(spark, sf_dir):
    """NULL, outer spaces, doubles and timestamps through CSV and back."""
    path = scratch_path(spark, "csv")
    write_csv(orders_target(spark, sf_dir), path)
    return read_csv(spark, path)


@query("SELECT doc_id, text, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 11 = 0 THEN NULL ELSE lang END AS lang FROM documents")
def csv_roundtrip_text(spark, sf_dir):
    """Whole texts with quotes and line breaks; empty text and NULL stay apart."""
    path = scratch_path(spark, "csv")
    lang = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 11 != 0, F.col("lang"))
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", lang.alias("lang")), path)
    return read_csv(spark, path)


@query(ORDERS_DIFF_SQL)
def report_roundtrip(spark, sf_dir):
    """The difference report, written and read back."""
    path = scratch_path(spark, "report")
    result = reconcile(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"])
    write_report(result.diff, path)
    return read_diff(spark, path)


@query(ORDERS_DIFF_SQL)
def validation_report(spark, sf_dir):
    """Compared and reported in one call, and the report read back."""
    path = scratch_path(spark, "report")
    compare_and_report(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"], path)
    return read_diff(spark, path)


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
    's' || CAST(o_orderkey % 3 AS VARCHAR) AS _source_server FROM orders WHERE o_totalprice > 50000""")
def load_servers_csv(spark, sf_dir):
    """One CSV folder per server, each loaded with its schema and filtered."""
    orders = table(spark, sf_dir, "orders")
    frames = {f"s{i}": orders.filter(F.col("o_orderkey") % 3 == i) for i in range(3)}
    extracts = extract_servers(frames, scratch_path(spark, "servers"))
    wanted = [replace(e, where="o_totalprice > 50000") for e in extracts]
    return union_servers(load_servers(spark, wanted), strict=True)


_MAPPED = """SELECT o_orderkey AS order_key, coalesce(upper(trim(o_orderstatus)), 'N') AS status,
    CASE WHEN upper(trim(o_orderstatus)) = 'O' THEN 1 ELSE 0 END AS is_open, round(o_totalprice, 1) AS price,
    CASE WHEN round(o_totalprice, 1) > 150000 THEN 'high' ELSE 'low' END AS price_class,
    CAST(o_orderdate AS DATE) AS order_day, trim(lower(substring(trim(o_orderpriority), 3, 20))) AS priority,
    'EUR' AS currency, CAST(NULL AS VARCHAR) AS old_id, 's' || CAST(o_orderkey % 3 AS VARCHAR) AS server FROM ({rows}) r
    WHERE o_orderdate >= TIMESTAMP '1994-01-01'"""


@query(sql_diff(
    _MAPPED.format(rows="SELECT * FROM orders"), _MAPPED.format(rows=TARGET_SQL), ["order_key"],
    {
        "currency": sql_text, "is_open": sql_plain, "old_id": sql_plain, "order_day": sql_plain, "price": sql_number,
        "price_class": sql_text, "priority": sql_text, "status": sql_text,
    },
    server="server",
))
def validation_run(spark, sf_dir):
    """Three servers are loaded, mapped, united and filtered, and compared with the target."""
    path = f"{sf_dir}/orders.parquet"
    servers = [ServerSource(f"s{i}", path, "parquet", where=f"o_orderkey % 3 = {i}") for i in range(3)]
    mapping = order_map()

    def target(session):
        rows = orders_target(session, sf_dir).withColumn("o_orderpriority", F.trim("o_orderpriority"))
        return apply_mapping(rows, mapping)

    job = ValidationJob(
        servers, {s.name: mapping for s in servers}, target, ["ORDER_KEY"],
        date_range={"mode": "range", "date_from": "1994-01-01", "from_col": "ORDER_DAY"},
    )
    return run_validation(spark, job).result.diff


@query("""SELECT c_custkey, 'C:\\new\\red' || '\\' || c_name AS folder, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '\\N' || c_custkey END AS code,
    'q"' || c_name || '"' AS quoted FROM customer""")
def csv_foreign(spark, sf_dir):
    """CSV that others wrote, with a schema beside it and no manifest: its backslashes are its own."""
    path = scratch_path(spark, "csv")
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        key,
        F.concat(F.lit("C:\\new\\red\\"), "c_name").alias("folder"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("\\N"), key)).alias("code"),
        F.concat(F.lit('q"'), "c_name", F.lit('"')).alias("quoted"),
    )
    rows.write.options(header="true", escape='"', emptyValue='""').csv(path)
    spark.createDataFrame([(rows.schema.json(),)], "schema string").coalesce(1).write.text(schema_path(path))
    return read_csv(spark, path)


@query("SELECT * FROM orders WHERE o_orderkey BETWEEN 1000 AND 2500")
def csv_key_range(spark, sf_dir):
    """A range of keys from a CSV folder: the manifest says which files can hold them."""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").repartitionByRange(8, "o_orderkey")
    write_csv(orders, path, ranges=["o_orderkey"])
    return read_csv(spark, path, verify="rows", key_range=KeyRange("O_ORDERKEY", 1000, 2500))
