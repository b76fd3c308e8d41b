"""What the plans look like, and what the library must not contain."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from driver_queries.mapping import order_map
from driver_queries.registry import orders_target, table
from tallymark.operators.filters import date_window, pk_filter
from tallymark.operators.joins import null_safe_join
from tallymark.operators.keys import keys_in, keys_not_in
from tallymark.operators.mapping import apply_mapping, select_partial
from tallymark.operators.rownumber import number_rows
from tallymark.plans.reconcile import _anti_outcome, _full_outcome, _hash_outcome, _stacked_outcome, prepare, reconcile, slim_pairs
from tests.conftest import rows

LIBRARY = Path(__file__).resolve().parents[1] / "tallymark"


def plan(df, mode="simple"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def test_filters_reach_the_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(date_window(orders, "range", "1995-01-01", "o_orderdate"), "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", text)
    text = plan(pk_filter(orders, "o_orderkey", "range", 5, 9), "formatted")
    assert "GreaterThanOrEqual(o_orderkey,5)" in text and "LessThanOrEqual(o_orderkey,9)" in text
    mapped = apply_mapping(orders, order_map(), null_check="off").filter("ORDER_KEY > 7")
    assert "GreaterThan(o_orderkey,7)" in plan(mapped, "formatted")


def test_only_needed_columns_are_read(spark, sf_dir):
    part = apply_mapping(table(spark, sf_dir, "orders"), select_partial(order_map(), ["is_open"]), null_check="off")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan(part, "formatted")


def test_slim_comparison_is_one_narrow_shuffle_without_a_join(spark, sf_dir):
    sides = prepare(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"])
    text = plan(slim_pairs(sides))
    assert "Join" not in text and "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning(o_orderkey") == 1 and text.count("Exchange") == 1


def test_equal_types_are_compared_without_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sides = prepare(orders, orders, ["o_orderkey"])
    assert dict(sides.source.dtypes) == {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
        "o_orderstatus": "string", "o_totalprice": "double",
    }


def test_row_numbers_move_no_table_to_one_task(spark, sf_dir):
    text = plan(number_rows(table(spark, sf_dir, "orders"), ["o_orderkey"]))
    assert "SinglePartition" not in text and "Window" not in text
    assert "BroadcastHashJoin" in text


def test_null_safe_joins_are_hash_partitioned(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = table(spark, sf_dir, "orders")
        for how in ("full", "inner"):
            text = plan(null_safe_join(orders, orders, ["o_orderkey"], how))
            assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
        assert "SortMergeJoin" in plan(keys_in(orders, orders, ["o_orderkey"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordinal_pairing_moves_rows_once(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    target = lines.filter("l_suppkey % 7 <> 0")
    result = reconcile(lines, target, ["l_orderkey"], on_duplicate="ordinal")
    text = plan(_stacked_outcome(result.sides))
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(l_orderkey" in text and "Join" not in text
    # not numbered and joined beforehand either
    assert "Join" not in plan(result.sides.source) and "Window" not in plan(result.sides.source)
    by_join = reconcile(lines, target, ["l_orderkey"], method="full", on_duplicate="ordinal")
    hot = reconcile(lines, target, ["l_orderkey"], on_duplicate="ordinal", hot_key_rows=3)
    assert result.counts == by_join.counts == hot.counts and result.counts.missing_rows > 0
    assert rows(result.diff) == rows(by_join.diff) == rows(hot.diff)


def test_key_sets_of_unknown_size_are_never_broadcast(spark, sf_dir):
    """The size of a table's keys is guessed from its files, which may hold very many of them in a few bytes."""
    source, target = table(spark, sf_dir, "orders"), orders_target(spark, sf_dir)
    found = [_anti_outcome(prepare(source, target, ["o_orderkey"])), *(f(source, target, ["o_orderkey"]) for f in (keys_in, keys_not_in))]
    for df in found:
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)
    assert "BroadcastHashJoin" in plan(keys_in(source, target, ["o_orderkey"], few=True))


def test_details_have_one_plan_whatever_the_number_of_differences(spark, sf_dir):
    source, target = table(spark, sf_dir, "orders"), orders_target(spark, sf_dir)
    many = plan(reconcile(source, target, ["o_orderkey"]).diff_plan())
    one = plan(reconcile(source, source.filter("o_orderkey <> 7"), ["o_orderkey"]).diff_plan())
    assert "LeftSemi" in many and "In(o_orderkey" not in many + one
    few = source.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 7, 0.0).otherwise(F.col("o_totalprice")))
    few = plan(reconcile(source, few, ["o_orderkey"]).diff_plan())
    assert few.count("LeftSemi, BuildRight") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(reconcile(source, target, ["o_orderkey"]).diff_plan())
        # the outcome itself is never broadcast; the Bloom filters of its keys are, three of bounded size, each from a
        # narrow shuffle of its own
        joins = [line for line in text.splitlines() if re.search(r"BroadcastHashJoin", line)]
        assert len(joins) == 2 and all("_tm_word" in line for line in joins) and "SortMergeJoin" in text
        # both semi joins and the join of their results share one partitioning of each table
        exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert len([line for line in exchanges if "_groupingexpression" not in line]) <= 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hash_outcome_moves_rows_once(spark, sf_dir):
    sides = prepare(table(spark, sf_dir, "orders"), orders_target(spark, sf_dir), ["o_orderkey"])
    assert plan(_hash_outcome(sides)).count("Exchange") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(_full_outcome(sides)).count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_outcome_is_as_small_as_the_differences(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    for method in ("hash", "full", "anti"):
        assert reconcile(orders, orders, ["o_orderkey"], method=method).outcome.count() == 0


def test_mapping_stays_in_generated_code(spark, sf_dir):
    mapped = apply_mapping(table(spark, sf_dir, "orders"), order_map(), null_check="off")
    text = plan(mapped, "codegen")
    assert "Found 1 WholeStageCodegen subtrees" in text
    assert "Python" not in plan(mapped)


def test_library_has_no_python_row_work_and_no_hidden_actions():
    """Data stays on the executors: the few driver reads are of bounded size."""
    source = {p.relative_to(LIBRARY).as_posix(): p.read_text() for p in LIBRARY.rglob("*.py") if "llm" not in p.parts}
    for name, text in source.items():
        assert not re.search(r"udf|InPandas|toPandas|\.rdd\b|crossJoin|localCheckpoint|toLocalIterator|\.coalesce\(1\)\.(?!write\.mode\(mode\)\.text)", text), name
    actions = {name: len(re.findall(r"\.(?:collect|first|take|head)\(", text)) for name, text in source.items()}
    assert {n: c for n, c in actions.items() if c} == {
        "operators/checks.py": 1,  # counts of required columns
        "operators/rownumber.py": 1,  # one row count per partition
        "operators/skipping.py": 3,  # bounds, quantiles and ranges of a key set
        "plans/digest.py": 1,  # one digest for each of 4,096 buckets
        "plans/reconcile.py": 1,  # the number of repeated keys
        "operators/vectorised.py": 1,  # none: rows of an Arrow array
        "sources/jdbc.py": 2,  # two bounds; quantiles of a column
        "sources/files.py": 6,  # the schema text; sums over a manifest, names of its files
    }
    broadcasts = {n: t.count("F.broadcast(") for n, t in source.items() if "F.broadcast(" in t}
    assert broadcasts == {
        "operators/rownumber.py": 1,  # one row per range partition
        "operators/skipping.py": 1,  # the words of a Bloom filter, 2 ** 18 at most
        "plans/digest.py": 2,  # unequal buckets, 2 ** 12 and 2 ** 16 at most
    }


def test_hot_lookup_key_can_be_split(spark):
    """A third of the rows share one key; with the threshold lowered Spark splits them."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    from tallymark.operators.joins import lookup_join

    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        main = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        other = spark.range(1500).select("id", F.concat(F.lit("n"), "id").alias("name"))
        for how in ("left", "inner", "right", "full"):
            joined = lookup_join(main, other, [("k", "id")], how, ["name"])
            assert joined.count() == {"left": 60000, "inner": 60000, "right": 60500, "full": 60500}[how]
            joined.collect()
            assert "SortMergeJoin(skew=true)" in plan(joined), how
    finally:
        for k in settings:
            spark.conf.unset(k)
