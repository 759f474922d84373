"""Chain verdicts by class, and digest trees that lead to the buckets that differ."""

import pytest
from pyspark.sql import functions as F

from chainframe.operators import aggregates, compare

TX = "chain_id long, block_number long, transaction_index long, tx_hash string, access_list string"
LOGS = "chain_id long, block_number long, log_index long, data string"
LOG = ["chain_id", "block_number", "log_index"]


def verdicts(spark, a, b, logs_a, logs_b, floors=((1, 10, 80),), failing=(), blocks=None, **more):
    txs = [spark.createDataFrame([(1, n, 0, f"t{n}", None) for n in own], TX) for own in (a, b)]
    logs = [spark.createDataFrame([(1, n, k, d) for n, k, d in own], LOGS) for own in (logs_a, logs_b)]
    cut = spark.createDataFrame([(1, 5)], "chain_id long, cutover long")
    fl = spark.createDataFrame(list(floors), "chain_id long, floor long, window_end long")
    st = spark.createDataFrame([(c, True) for c in failing], "chain_id long, failing boolean")
    others = {"logs": (*logs, LOG)}
    if blocks:
        others["blocks"] = tuple(spark.createDataFrame([(1, n, "h") for n in own], "chain_id long, block_number long, hash string") for own in blocks) + (["chain_id", "block_number"],)
    return compare.compare_chain(*txs, cut, fl, spark.createDataFrame([], "tx_hash string"), 0, st, others, width=10, **more).collect()[0]


BLOCKS = range(100)
EACH = [(n, 0, "d") for n in BLOCKS]


def test_a_stuck_side_fails_even_without_an_overlap(spark):
    assert verdicts(spark, BLOCKS, [1, 2], EACH, EACH[:2]).verdict == "PENDING"
    assert verdicts(spark, BLOCKS, [1, 2], EACH, EACH[:2], failing=[1]).verdict == "FAIL"
    assert verdicts(spark, BLOCKS, BLOCKS, EACH, EACH, failing=[1]).verdict == "FAIL"
    assert verdicts(spark, BLOCKS, BLOCKS, EACH, EACH).verdict == "PASS"


def test_rows_that_only_b_has_by_class(spark):
    without = lambda *gone: [x for x in EACH if x[0] not in gone]
    fine = verdicts(spark, BLOCKS, BLOCKS, without(20, 21, 55), EACH)
    assert (fine.verdict, fine.tolerated_logs, fine.buckets_logs, fine.explained_logs) == ("PASS", 3, 2, 2)
    low = verdicts(spark, BLOCKS, BLOCKS, without(9, 20), EACH)  # below the floor
    assert (low.verdict, low.tolerated_logs, low.hard_logs, low.explained_logs) == ("FAIL", 1, 1, 1)
    assert verdicts(spark, BLOCKS, BLOCKS, without(90), EACH).hard_logs == 1  # beyond the window's end
    assert verdicts(spark, BLOCKS, BLOCKS, without(20), EACH, floors=[(2, 0, 99)]).verdict == "FAIL"  # no floor is known
    assert verdicts(spark, BLOCKS, BLOCKS, EACH, without(20)).only_a_logs == 1
    changed = [(n, k, "x" if n in (20, 21) else d) for n, k, d in EACH if n != 22]
    both = verdicts(spark, BLOCKS, BLOCKS, changed, EACH)
    assert (both.verdict, both.mismatch_logs, both.tolerated_logs, both.explained_logs) == ("FAIL", 2, 1, 0)


def test_transactions_of_lost_blocks(spark):
    a = [n for n in BLOCKS if n != 30]
    lost = verdicts(spark, a, BLOCKS, EACH, EACH, blocks=(a, BLOCKS))
    assert (lost.verdict, lost.only_b_tolerated, lost.tolerated_blocks) == ("PASS", 1, 1)
    there = verdicts(spark, a, BLOCKS, EACH, EACH, blocks=(BLOCKS, BLOCKS))  # a has the block, but not its transaction
    assert (there.verdict, there.only_b_hard) == ("FAIL", 1)


@pytest.mark.parametrize("fan", [2, 3, 1000])
def test_trees_lead_to_the_buckets_that_differ(spark, fan):
    rows = [(c, n, 0, f"d{n}") for c in (1, 2) for n in range(0, 400, 3)]
    a = spark.createDataFrame(rows, LOGS)
    b = spark.createDataFrame([(c, n, k, "x" if (c, n) in ((1, 0), (2, 399)) else d) for c, n, k, d in rows if (c, n // 10) != (1, 17)] + [(1, 1000, 0, "new"), (3, 5, 0, "chain")], LOGS)
    trees = [compare.digest_tree(aggregates.bucket_digest(t, LOG, width=10), fan) for t in (a, b)]
    assert sorted(map(tuple, compare.differing_buckets(*trees, fan).collect())) == [(1, 0), (1, 17), (1, 100), (2, 39), (3, 0)]
    assert compare.differing_buckets(trees[0], trees[0], fan).collect() == []


def test_with_trees_only_differing_and_cut_buckets_are_read(spark):
    changed = [(n, k, "x" if n == 42 else d) for n, k, d in EACH]
    a, b = (spark.createDataFrame([(1, n, k, d) for n, k, d in own], LOGS) for own in (changed, EACH))
    trees = tuple(compare.digest_tree(aggregates.bucket_digest(t, LOG, width=10)) for t in (a, b))
    assert verdicts(spark, BLOCKS, BLOCKS, changed, EACH, trees={"logs": trees}).mismatch_logs == 1
    window = spark.createDataFrame([(1, 5, 99)], "chain_id long, lo long, hi long")
    # rows with another text in buckets that no tree calls different aren't met
    hidden = a.withColumn("data", F.when(F.col("block_number") == 75, "y").otherwise(F.col("data")))
    floors = spark.createDataFrame([(1, 10, 80)], "chain_id long, floor long, window_end long")
    got = compare.family_classes(hidden, b, LOG, window, floors, 10, trees).collect()[0]
    assert (got["mismatch"], got["buckets"]) == (1, 1)
    assert compare.family_classes(hidden, b, LOG, window, floors, 10).collect()[0]["mismatch"] == 2
