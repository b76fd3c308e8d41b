"""Bucket digests, pairing by cancellation, and key-set skipping."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from driver_queries.compare import _cancel_sides
from driver_queries.registry import table
from tallymark.operators.assignment import assign, pair_rows
from tallymark.operators.filters import pk_filter
from tallymark.operators.skipping import bloom_words, key_set_bounds, may_be_in, range_filter, skip_to, word_count
from tallymark.plans import digest as digests
from tallymark.plans import pairing
from tallymark.plans.digest import compare_digests
from tallymark.plans.reconcile import DuplicateKeys, prepare, reconcile
from tallymark.sources.servers import union_servers
from tests.conftest import rows
from tests.test_plans import plan

SCHEMA = "k bigint, a bigint, b string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


# -- digest -----------------------------------------------------------------------------


def test_equal_tables_move_no_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sides = prepare(orders, orders.orderBy(F.rand(3)), ["o_orderkey"])
    found = compare_digests(sides.source, sides.target, sides.keys, sides.columns)
    assert found.unequal is None and found.source_rows == orders.count()
    sides = prepare(orders, orders, ["o_orderkey"])
    text = plan(digests._digests(sides.source, sides.target, {"b": digests._coarse(sides.keys)}, sides.keys, sides.columns))
    assert "Join" not in text and text.count("Exchange") == 1 and text.index("partial_sum") > text.index("Exchange")


@pytest.mark.parametrize("changed", [1, 7])
def test_rows_in_question_follow_the_differences(spark, sf_dir, changed):
    orders = table(spark, sf_dir, "orders")
    target = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") <= changed, -1.0).otherwise(F.col("o_totalprice")))
    wrong = target.filter("o_totalprice = -1").count()
    sides = prepare(orders, target, ["o_orderkey"])
    found = compare_digests(sides.source, sides.target, sides.keys, sides.columns)
    asked = found.rows_in_question(sides.source, sides.keys)
    assert wrong <= asked.count() <= 3 * wrong + 3 < orders.count() // 10
    # the test is made where rows are read: no row of the table is shuffled for it
    assert "Exchange hashpartitioning" not in plan(asked)


@pytest.mark.parametrize("buckets", [(4, 8), (1 << 12, 1 << 16)])
def test_digest_equals_hash(spark, monkeypatch, buckets):
    monkeypatch.setattr(digests, "COARSE", buckets[0])
    monkeypatch.setattr(digests, "FINE", buckets[1])
    rng = random.Random(buckets[0])
    source = [(i, rng.randrange(5), rng.choice(["x", None, ""])) for i in range(400)] + [(None, 1, "n")]
    target = [r if rng.random() < 0.95 else (r[0], r[1], "changed") for r in source if rng.random() < 0.97] + [(900, 1, "e")]
    by_hash, by_digest = (reconcile(frame(spark, source), frame(spark, target), ["k"], method=m) for m in ("hash", "digest"))
    assert by_digest.counts == by_hash.counts and by_hash.counts.diff_rows > 0
    assert rows(by_digest.diff) == rows(by_hash.diff)


def test_digest_of_swapped_values_and_of_empty_tables(spark):
    """The same cells in other rows, and sums that could cancel, are not equal."""
    source, target = frame(spark, [(1, 5, "p"), (2, 6, "q")]), frame(spark, [(1, 6, "p"), (2, 5, "q")])
    assert reconcile(source, target, ["k"], method="digest").counts.mismatched_rows == 2
    nothing = frame(spark, [])
    assert reconcile(nothing, nothing, ["k"], method="digest").passed
    assert reconcile(source, nothing, ["k"], method="digest").counts.missing_rows == 2
    with pytest.raises(DuplicateKeys):
        reconcile(frame(spark, [(1, 1, "a"), (1, 1, "a")]), frame(spark, [(1, 1, "a")]), ["k"], method="digest")


def test_tables_that_differ_everywhere_are_not_digested_twice(spark, monkeypatch):
    monkeypatch.setattr(digests, "COARSE", 16)
    monkeypatch.setattr(digests, "FINE", 64)
    source = spark.range(4000).select(F.col("id").alias("k"), F.col("id").alias("a"), F.lit("x").alias("b"))
    target = source.withColumn("b", F.when(F.col("k") % 3 == 0, "y").otherwise("x")).filter("k % 10 <> 5")
    written = []
    monkeypatch.setattr(digests, "stash", lambda df, label: written.append(label))
    sides = prepare(source, target, ["k"])
    found = compare_digests(sides.source, sides.target, sides.keys, sides.columns)
    assert found.whole and not written  # the second pass writes what it finds
    assert found.rows_in_question(sides.source, sides.keys).count() == 4000
    by_hash, by_digest = (reconcile(source, target, ["k"], method=m, on_duplicate="cancel") for m in ("hash", "digest"))
    assert by_digest.counts == by_hash.counts and by_hash.counts.missing_rows == 400
    assert rows(by_digest.diff) == rows(by_hash.diff)


# -- cancellation -------------------------------------------------------------------------


def cancel_by_hand(source, target):
    """Matched, missing, extra and mismatched rows, and the least number of differing cells."""
    keys = defaultdict(lambda: (Counter(), Counter()))
    for side, data in enumerate((source, target)):
        for k, *cells in data:
            keys[k][side][tuple(cells)] += 1
    counts, cells = Counter(), 0
    for left, right in keys.values():
        counts["matched"] += sum((left & right).values())
        s, t = list((left - right).elements()), list((right - left).elements())
        counts["mismatched"] += min(len(s), len(t))
        counts["missing"] += max(0, len(s) - len(t))
        counts["extra"] += max(0, len(t) - len(s))
        few, many = sorted((s, t), key=len)
        if few:
            cells += min(sum(sum(x != y for x, y in zip(a, b)) for a, b in zip(few, p)) for p in permutations(many, len(few)))
    return counts, cells


@pytest.mark.parametrize("method", ["hash", "digest"])
@pytest.mark.parametrize("seed", [1, 2])
def test_cancellation_equals_brute_force(spark, method, seed):
    rng = random.Random(seed)
    row = lambda: (rng.choice([None, *range(12)]), rng.randrange(3), rng.choice(["x", "y", None]))
    source = [row() for _ in range(70)]
    target = [r if rng.random() < 0.7 else (r[0], rng.randrange(3), r[2]) for r in source if rng.random() < 0.9] + [row(), row()]
    counts, cells = cancel_by_hand(source, target)
    result = reconcile(frame(spark, source), frame(spark, target), ["k"], method=method, on_duplicate="cancel")
    assert (result.counts.matched_rows, result.counts.missing_rows, result.counts.extra_rows, result.counts.mismatched_rows) == (
        counts["matched"], counts["missing"], counts["extra"], counts["mismatched"]
    )
    assert (result.counts.source_rows, result.counts.target_rows) == (len(source), len(target))
    found = Counter(r["diff_type"] for r in result.diff.collect())
    assert found == Counter(VALUE_MISMATCH=cells, MISSING_IN_TARGET=counts["missing"], EXTRA_IN_TARGET=counts["extra"]) + Counter()


def test_one_missing_row_is_one_difference(spark):
    source, target = frame(spark, [(1, i, "x") for i in range(1, 8)]), frame(spark, [(1, i, "x") for i in range(2, 8)])
    found = reconcile(source, target, ["k"], on_duplicate="cancel").counts
    assert (found.matched_rows, found.missing_rows, found.mismatched_rows) == (6, 1, 0)
    assert reconcile(source, target, ["k"], on_duplicate="ordinal").counts.mismatched_rows == 6


def test_hot_key_is_cancelled_and_paired_by_order(spark, monkeypatch):
    """One key holds most rows: they fold, and what is left of it is paired by order over several tasks."""
    monkeypatch.setattr(pairing, "ASSIGN_ROWS", 10)
    source = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 50).alias("a"), F.lit("x").alias("b")
    )
    target = source.withColumn("b", F.when((F.col("k") == 7) & (F.col("a") < 2), "y").otherwise(F.col("b")))
    wrong = target.filter("b = 'y'").count()
    found = reconcile(source, target, ["k"], on_duplicate="cancel", hot_key_rows=20)
    assert found.counts.mismatched_rows == wrong > 100 and found.counts.matched_rows == 6000 - wrong
    assert {(r["column_name"], r["expected_value"], r["actual_value"]) for r in found.diff.collect()} == {("b", "x", "y")}


def test_cancellation_names_the_last_servers(spark):
    same = frame(spark, [(1, 1, "x"), (2, 2, "y")])
    source = union_servers({"s1": same, "s0": same, "s2": same})
    diff = reconcile(source, same, ["k"], on_duplicate="cancel").diff
    assert Counter(r["source_server"] for r in diff.collect()) == {"s1": 2, "s2": 2}
    changed = frame(spark, [(1, 5, "x"), (2, 2, "y"), (2, 2, "y"), (2, 2, "y")])
    diff = reconcile(source, changed, ["k"], on_duplicate="cancel").diff.collect()
    assert Counter(r["diff_type"] for r in diff) == {"VALUE_MISMATCH": 1, "MISSING_IN_TARGET": 2}


def test_cancellation_refuses_other_methods(spark):
    with pytest.raises(ValueError, match="cancel"):
        reconcile(frame(spark, []), frame(spark, []), ["k"], method="full", on_duplicate="cancel")


def test_assignment_is_optimal():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n, m = sorted(rng.integers(1, 6, 2))
        cost = rng.integers(0, 5, (n, m)).astype(float)
        taken = assign(cost)
        assert len(set(taken)) == n
        best = min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(m), int(n)))
        assert cost[np.arange(n), taken].sum() == best
    left, right = pair_rows(np.array([[1, 2], [3, 4], [5, 6]]), np.array([[5, 7], [1, 2]]))
    assert sorted(left) == [1, 2, 3] and left[2] == right[0] and left[0] == right[1]


# -- skipping ---------------------------------------------------------------------------------


def test_skipping_loses_no_key(spark):
    rng = random.Random(9)
    table_ = spark.createDataFrame([(rng.choice([None, *range(2000)]), rng.choice("abc"), i) for i in range(5000)], "k bigint, c string, v int")
    wanted = table_.sample(0.02, 5).select("k", "c").distinct()
    bounds, count = key_set_bounds(wanted, ["k", "c"])
    near = skip_to(table_, wanted, ["k", "c"], bounds, count)
    on = table_["k"].eqNullSafe(wanted["k"]) & (table_["c"] == wanted["c"])
    truly = rows(table_.join(wanted, on, "left_semi"))
    kept = rows(near)
    assert set(truly) <= set(kept) and len(kept) < 0.5 * table_.count()


def test_bloom_filter_is_bounded(spark):
    assert [word_count(n) for n in (0, 100, 10**5, 10**12)] == [64, 64, 16384, 1 << 18]
    keys = spark.range(20000).select((F.col("id") * 7).alias("k"))
    words = bloom_words(keys, ["k"], 64)
    assert words.count() == 64
    # a full filter lets all pass and still loses nothing
    assert may_be_in(keys, words, ["k"], 64).count() == 20000


def test_key_sets_reach_the_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(pk_filter(orders, "o_orderkey", "set", values=[5, 900, 901, 77]), "formatted")
    assert "GreaterThanOrEqual(o_orderkey,5)" in text and "LessThanOrEqual(o_orderkey,901)" in text
    assert "Or(" in text  # the ranges between
    table_of_keys = orders.filter("o_orderkey % 97 = 0").select("o_orderkey")
    text = plan(pk_filter(orders, "o_orderkey", "set", values=table_of_keys), "formatted")
    assert "GreaterThanOrEqual(o_orderkey,97)" in text and "_tm_word" in text
    few = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey").isin(40, 44, 47), 0.0).otherwise(F.col("o_totalprice")))
    result = reconcile(orders, few, ["o_orderkey"])
    changed = sorted(int(r["primary_key_value"]) for r in result.diff.collect())
    text = plan(result.diff_plan(), "formatted")
    assert f"GreaterThanOrEqual(o_orderkey,{changed[0]})" in text and f"LessThanOrEqual(o_orderkey,{changed[-1]})" in text


def test_key_sets_of_odd_types(spark):
    """Keys whose equal values hash apart, or whose type differs, are semi-joined alone."""
    data = spark.createDataFrame([(0.0, 1), (-0.0, 2), (1.5, 3), (None, 4)], "k double, v int")
    assert [r["v"] for r in pk_filter(data, "k", "set", values=spark.createDataFrame([(0.0,)], "k double")).collect()] == [1, 2]
    texts = spark.createDataFrame([("5", 1), ("7", 2), (None, 3)], "k string, v int")
    assert [r["v"] for r in pk_filter(texts, "k", "set", values=spark.createDataFrame([(5,)], "k int")).collect()] == [1]
    assert pk_filter(texts, "k", "set", values=[]).collect() == []
    assert pk_filter(texts, "k", "set", values=[None]).collect() == []
    assert range_filter(texts, texts, "k") is None


def test_what_is_left_over_is_counted_by_key_once(spark):
    """Six readers follow: each would count and join again."""
    source = frame(spark, [(1, 1, "a"), (1, 1, "a"), (2, 5, None), (None, 3, "n")])
    target = frame(spark, [(1, 1, "a"), (1, 2, "a"), (None, 3, "n"), (4, 1, "e")])
    sides = prepare(source, target, ["k"])
    left = pairing.Surplus(sides.source, sides.target, sides.keys, sides.columns)
    assert "Exchange" not in plan(left.table) and "Join" not in plan(left.table)
    assert rows(left.table.select("k", "src_left", "tgt_left")) == [(1, 1, 1), (1, 1, 1), (2, 1, 0), (4, 0, 1)]


def test_the_target_of_the_cancelling_queries_is_numbered_once(spark, sf_dir):
    lines, target = _cancel_sides(spark, sf_dir)
    assert "Exchange" not in plan(target) and "Join" not in plan(target)
    gone = lines.exceptAll(target).filter("l_orderkey % 10 = 5")
    assert gone.count() == lines.filter("l_orderkey % 10 = 5").select("l_orderkey").distinct().count()
