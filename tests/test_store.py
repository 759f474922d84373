"""Batches of a store, and scans and filters that read no more than they must."""

import re

import pytest
from pyspark.sql import functions as F

from chainframe.operators import filters
from chainframe.sources import blocks as src
from chainframe.sources.backfill import Backfill
from chainframe.sources.manifest import Store, among

LOGS = "chain_id long, block_number long, log_index long, address string, topic0 string"
KEYS = ["chain_id", "block_number", "log_index"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(spark, chains=range(1, 4), blocks=range(0, 60), by=1):
    return spark.createDataFrame([(c, n, 0, f"a{n % 7}", f"t{n % 3}") for c in chains for n in blocks[::by]], LOGS)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or KEYS)).collect()))


def test_batches_count_once_and_touch_their_own_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), LOGS, KEYS, width=10)
    assert store.read().collect() == [] and store.partitions().collect() == []
    assert store.append(made(spark, blocks=range(0, 40)), "b1").count() == 120
    new = made(spark, chains=[2], blocks=range(30, 50))
    assert rows(store.append(new, "b2")) == [(2, n, 0) for n in range(40, 50)]
    assert store.append(new, "b2").count() == 10 and store.append(new, "b3").count() == 0
    assert rows(store.read()) == rows(made(spark, blocks=range(0, 40)).unionByName(made(spark, [2], range(40, 50))))
    assert rows(store.partitions(), "chain_id", "block_bucket") == [(1, k) for k in range(4)] + [(2, k) for k in range(5)] + [(3, k) for k in range(4)]
    own = new.withColumn("block_bucket", F.floor(F.col("block_number") / 10).cast("long"))
    scan = next(line for line in plan(store.lacking(own)).splitlines() if "FileScan" in line)
    assert "PartitionFilters" in scan and re.search(r"chain_id#\d+L? = 2", scan) and re.search(r"block_bucket#\d+L? IN \(3,4\)", scan)


def test_a_failed_batch_leaves_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), LOGS, KEYS, width=10)
    store.append(made(spark, blocks=range(0, 20)), "b1")
    bad = made(spark, blocks=range(20, 40)).withColumn("address", F.when(F.col("block_number") == 33, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("address")))
    with pytest.raises(Exception, match="broken"):
        store.append(bad, "b2")
    assert store.batches() == ["b1"] and store.read().count() == 60
    # and one that was cut off after its rows, before its manifest
    made(spark, [1], range(20, 30)).withColumn("block_bucket", F.lit(2)).write.partitionBy("chain_id", "block_bucket").parquet(str(tmp_path / "s" / "batch=b3"))
    assert store.read().count() == 60
    assert store.append(made(spark, [1], range(20, 30)), "b3").count() == 10 and store.read().count() == 70
    with pytest.raises(ValueError, match="name"):
        store.append(bad, "../x")


def test_ranges_prune_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), LOGS, KEYS, width=10)
    store.append(made(spark), "b1")
    ranges = spark.createDataFrame([(1, 12, 25), (2, None, 5), (3, 51, None)], "chain_id long, lo long, hi long")
    got = src.scan_windows(store.read(), ranges, store.partitions(), width=10)
    assert "dynamicpruning" in plan(got).lower()
    assert rows(got) == [(1, n, 0) for n in range(10, 30)] + [(2, n, 0) for n in range(0, 10)] + [(3, n, 0) for n in range(50, 60)]
    got.collect()
    nodes, found = [got._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif "QueryStageExec" in node.getClass().getSimpleName():
            nodes.append(node.plan())
        if node.getClass().getSimpleName() == "FileSourceScanExec" and "address" in node.toString():
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
    assert found == [4]  # of 18


def test_filters_read_the_partitions_of_their_ranges(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), LOGS, KEYS, width=src.BUCKET)
    logs = made(spark, chains=[1, 2], blocks=range(0, 5 * src.BUCKET), by=100)
    store.append(logs, "b1")
    f = spark.createDataFrame([(1, "A1", 1500, 2500), (2, None, 4200, None)], "chain_id long, address string, from_block long, to_block long")
    got = filters.match_logs(store.read(), f, partitions=store.partitions())
    assert "dynamicpruning" in plan(got).lower() and rows(got) == rows(filters.match_logs(logs, f))
    assert rows(got) == [(c, n, 0) for c, n, *_ in rows(logs) if c == 1 and n % 7 == 1 and 1500 <= n <= 2500 or c == 2 and n >= 4200]


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


CHILDREN = [("f", 1, "a1", 10), ("f", 1, "a2", 40), ("g", 2, "a3", 0), ("h", 1, "a5", 0)]
FILTERS = [(1, None, "f", None, None), (1, "a4", None, None, 30), (2, None, "g", "t1", None), (1, None, None, "T2", 5)]


def test_many_children_cost_one_shuffle_of_candidates(no_broadcast, tmp_path, monkeypatch):
    """With more children than are sent, logs are shuffled once, by chain and address and salt, and no filter adds to that."""
    spark = no_broadcast
    made(spark).write.parquet(str(tmp_path / "l"))
    logs = spark.read.parquet(str(tmp_path / "l"))
    children = spark.createDataFrame(CHILDREN, "factory_id string, chain_id long, child string, created_block long")
    f = spark.createDataFrame(FILTERS, "chain_id long, address string, address_factory string, topic0 string, to_block long")
    want = rows(filters.match_logs(logs, f, children))
    few = plan(filters.match_logs(logs, f, children))
    assert "hashpartitioning" not in few
    monkeypatch.setattr(filters, "_few", lambda df: False)
    got = filters.match_logs(logs, f, children)
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan(got))
    of_logs = [s for s in shuffles if not s.startswith("__chain")]  # the others are of the children
    assert len(of_logs) == 1 and "__ask_address" in of_logs[0], shuffles
    assert rows(got) == want
    brute = {(c, n, 0) for c, n, _, a, t in map(tuple, logs.collect()) if c == 1 and (a == "a1" and n >= 10 or a == "a2" and n >= 40 or a == "a4" and n <= 30 or t == "t2" and n <= 5) or c == 2 and a == "a3" and t == "t1"}
    assert set(want) == brute


def test_a_hot_child_is_split(spark, monkeypatch, tmp_path):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(filters, "_few", lambda df: False)
    try:
        spark.range(40_000).selectExpr("1L AS chain_id", "id AS block_number", "0L AS log_index", "CASE WHEN id % 2 = 0 THEN 'hot' ELSE concat('a', id) END AS address", "sha2(CAST(id AS STRING), 256) AS topic0").repartition(12).write.parquet(str(tmp_path / "l"))
        logs = spark.read.parquet(str(tmp_path / "l"))
        children = spark.range(2000).selectExpr("'f' AS factory_id", "1L AS chain_id", "CASE WHEN id = 0 THEN 'hot' ELSE concat('a', id) END AS child", "0L AS created_block")
        f = spark.createDataFrame([(1, "f")], "chain_id long, address_factory string")
        got = filters.match_logs(logs, f, children)
        n = got.count()
        text = got.groupBy().count()
        text.collect()
        assert "skew=true" in plan(text) and n == 20_000 + 1000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    from chainframe.sources import store

    got = store.write_observed({"logs": made(spark), "few": made(spark, [2], range(5))}, str(tmp_path / "w"), [1, 2, 3, 9])
    assert rows(got, *got.columns) == [(1, 60, 0), (2, 60, 5), (3, 60, 0), (9, 0, 0)]
    assert spark.read.parquet(str(tmp_path / "w" / "logs")).count() == 180
    with pytest.raises(Exception, match="unknown chain 3"):
        store.write_observed({"logs": made(spark)}, str(tmp_path / "x"), [1, 2])


def test_rows_in_order_of_chains_are_written_without_another_sort(spark, tmp_path):
    from chainframe.sources import store

    own = made(spark).repartition(2, "chain_id").sortWithinPartitions("chain_id", "block_number")
    store.write_observed({"logs": own}, str(tmp_path / "w"), [1, 2, 3])
    said = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [said.apply(k).physicalPlanDescription() for k in range(said.size())]
    written = [p for p in plans if str(tmp_path / "w") in p][-1].split("== Initial Plan ==")[0]
    assert len(set(re.findall(r"^\W*Sort \(\d+\)", written, re.M))) == 1


def want(spark, *ranges):
    return spark.createDataFrame(list(ranges), "chain_id long, want_lo long, want_hi long")


def test_backfill_reads_what_is_missing_and_no_more(spark, tmp_path):
    source, into = (Store(spark, str(tmp_path / n), LOGS, KEYS, width=10) for n in ("all", "own"))
    source.append(made(spark), "all")
    job = Backfill(into, source, "t1", lambda df: df.where("topic0 = 't1'"))
    assert rows(job.fill(want(spark, (1, 15, 35), (2, 0, 10)), "a")) == [(1, n, 0) for n in range(16, 35, 3)] + [(2, n, 0) for n in range(1, 10, 3)]
    assert rows(job.covered(), "chain_id", "lo", "hi") == [(1, 15, 35), (2, 0, 10)]
    for bucket in tmp_path.glob("all/batch=all/chain_id=1/block_bucket=2/*.parquet"):  # read already, and unreadable since
        bucket.write_bytes(b"broken")
    got = job.fill(want(spark, (1, 10, 45), (2, 5, 8), (3, 55, 90)), "b")
    assert rows(got) == [(1, n, 0) for n in (10, 13, 37, 40, 43)] + [(3, n, 0) for n in (55, 58)]
    assert rows(job.covered(), "chain_id", "lo", "hi") == [(1, 10, 45), (2, 0, 10), (3, 55, 90)]
    assert job.missing(want(spark, (1, 10, 45), (3, 55, 90))).collect() == [] and job.fill(want(spark, (1, 10, 45)), "c").collect() == []
    other = Backfill(into, source, "all", lambda df: df)  # another spec has read nothing; rows of both count once
    assert other.fill(want(spark, (2, 0, 10)), "a").count() == 7 and into.read().where("chain_id = 2").count() == 10
    with pytest.raises(ValueError, match="name"):
        job.fill(want(spark, (1, 0, 1)), "../x")


def test_a_backfill_that_failed_runs_again_by_its_plan(spark, tmp_path):
    source, into = (Store(spark, str(tmp_path / n), LOGS, KEYS, width=10) for n in ("all", "own"))
    source.append(made(spark, [1]), "all")
    broken = F.when(F.col("block_number") == 33, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("address"))
    with pytest.raises(Exception, match="broken"):
        Backfill(into, source, "s", lambda df: df.withColumn("address", broken)).fill(want(spark, (1, 0, 40)), "a")
    job = Backfill(into, source, "s", lambda df: df)
    assert job.covered().collect() == [] and into.read().collect() == []
    assert job.fill(want(spark, (1, 0, 20)), "a").count() == 20  # nothing of the first attempt was seen, so it is planned anew
    assert rows(job.covered(), "lo", "hi") == [(0, 20)]
    spark.createDataFrame([(1, 20, 30)], "chain_id long, lo long, hi long").write.parquet(f"{job.folder}/planned/batch=b")
    into.append(source.read().where("block_number BETWEEN 20 AND 29"), "s-b")  # cut off before its coverage was written
    assert job.fill(want(spark, (1, 0, 60)), "b").count() == 10 and rows(job.covered(), "lo", "hi") == [(0, 30)]
    assert job.fill(want(spark, (1, 0, 60)), "c").count() == 30


def listing_tasks(spark, run):
    """The tasks of the stages that ``run`` starts."""
    sc, group = spark.sparkContext, f"listing-{id(run)}"
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return [s.numTasks for s in stages if s is not None]


def test_a_store_is_listed_once_and_by_few_tasks(spark, tmp_path):
    path, key = str(tmp_path / "s"), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    store, old = Store(spark, path, LOGS, KEYS, width=1), spark.conf.get(key)
    written = store.append(made(spark, [1]), "b1")
    assert listing_tasks(spark, lambda: store._of(["b1"])) == [] and written.count() == 60
    fresh = Store(spark, path, LOGS, KEYS, width=1)
    assert 0 < sum(listing_tasks(spark, lambda: fresh._of(["b1"]))) <= 33  # of 60 partitions
    assert spark.conf.get(key) == old and rows(fresh.read()) == rows(made(spark, [1]))
    assert fresh.append(made(spark, [1, 2], range(50, 70)), "b2").count() == 30 and rows(fresh.read(), "chain_id").count((2,)) == 20
    assert store.read().count() == 90  # another writer's batch is seen


def test_long_runs_of_buckets_are_bounds(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), LOGS, KEYS, width=1)
    store.append(made(spark, [1, 2]), "b1")
    new = made(spark, [1], [*range(5, 30), 40, 42, 70]).withColumn("block_bucket", F.col("block_number"))
    lacking = store.lacking(new)
    many = {*range(5, 30), 40, 42, 70}
    met = spark.range(80).withColumnRenamed("id", "block_bucket").where(among(many))
    assert re.search(r">= 5\).*<= 29\).* IN \(40,42,70\)", plan(met)) and {r[0] for r in met.collect()} == many
    assert rows(lacking) == [(1, 70, 0)]


def test_an_attempt_that_failed_before_its_manifest_is_listed_anew(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"), LOGS, KEYS, width=10)
    with monkeypatch.context() as m:
        m.setattr(F, "count", lambda *_: F.raise_error(F.lit("no manifest")).cast("long"))
        with pytest.raises(Exception):
            store.append(made(spark, [1], range(0, 20)), "b1")
    assert store.batches() == []
    assert store.append(made(spark, [1], range(30, 50)), "b1").count() == 20 and rows(store.read()) == [(1, n, 0) for n in range(30, 50)]
