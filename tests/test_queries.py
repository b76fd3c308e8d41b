"""Every registered query against its oracle SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from driver_queries import ORACLES, QUERIES
from tools.check_queries import compare, connect


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    problem, _, count = compare(spark, oracle, sf_dir, name)
    assert problem is None
    assert count > 0


def test_scans_are_balanced_over_keys_whose_cubes_are_no_bigint(spark, sf_dir, tmp_path):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    shifted = orders.withColumn("o_orderkey", F.col("o_orderkey") + 9_000_000_000)
    orders.unionByName(shifted).write.parquet(f"{tmp_path}/orders.parquet")
    row = entry.queries()["scan_predicates_balanced"](spark, str(tmp_path)).first()
    keys = [r[0] for r in orders.select("o_orderkey").collect()]
    nulls = sum(k % 20 == 0 for k in keys)  # the shift is a multiple of 20
    assert (row["row_count"], row["scans"], row["balanced"], row["null_rows"]) == (2 * len(keys), 8, True, 2 * nulls)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_gives_the_known_counts(spark):
    found = {(r["diff_type"], r["column_name"]): r["count"] for r in entry.entry(spark).collect()}
    assert found == {
        ("MISSING_IN_TARGET", "<ENTIRE_ROW>"): 89,
        ("EXTRA_IN_TARGET", "<ENTIRE_ROW>"): 66,
        ("VALUE_MISMATCH", "o_orderstatus"): 48,
        ("VALUE_MISMATCH", "o_totalprice"): 109,
    }
