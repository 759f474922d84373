"""Streams over a store of batches, resumed by the last block of each chain."""

import pytest
from pyspark.sql import functions as F

from chainframe.sources.manifest import Store
from chainframe.streaming import block_source, sinks

LOGS = "chain_id long, block_number long, log_index long, address string"
KEYS = ["chain_id", "block_number", "log_index"]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), LOGS, KEYS, width=10)


def made(spark, chains, blocks):
    return spark.createDataFrame([(c, n, i, f"a{n}") for c in chains for n in blocks for i in range(2)], LOGS)


def run(spark, store, base, **options):
    """Rows that one more run of the query delivers, and how many tasks they came from."""
    seen = []

    def batch(df, i):
        sinks.write_batch(df.withColumn("task", F.spark_partition_id()), i, f"{base}/out")
        seen.append(i)

    sinks.run_available(block_source.stream_store(spark, store.path, LOGS, width=10, **options), batch, f"{base}/checkpoint")
    rows = [r for i in seen for r in spark.read.parquet(f"{base}/out/batch_id={i}").collect()]
    return sorted({(r.chain_id, r.block_number) for r in rows}), len(rows), len({r.task for r in rows})


def test_each_chain_resumes_at_its_own_block(spark, store, tmp_path):
    base = str(tmp_path / "q")
    assert run(spark, store, base) == ([], 0, 0)  # no batch yet
    store.append(made(spark, [1, 2], range(0, 25)), "a")
    got, n, tasks = run(spark, store, base)
    assert got == [(c, k) for c in (1, 2) for k in range(25)] and n == 100
    assert tasks == 6  # three partitions a chain, side by side
    assert run(spark, store, base) == ([], 0, 0)
    store.append(made(spark, [1], range(25, 28)), "b")
    store.append(made(spark, [2, 3], range(25, 45)), "c")
    got, n, _ = run(spark, store, base)
    assert got == [(1, k) for k in range(25, 28)] + [(c, k) for c in (2, 3) for k in range(25, 45)] and n == 86


def test_any_offset_and_any_end(spark, store, tmp_path):
    store.append(made(spark, [1, 2], range(0, 30)), "a")
    for lo, hi in ((0, 4), (9, 10), (10, 19), (28, 29), (29, 50), (12, 26)):
        got, *_ = run(spark, store, str(tmp_path / f"q{lo}-{hi}"), after={1: lo, 2: 5}, end=hi)
        assert got == [(1, k) for k in range(lo + 1, min(hi, 29) + 1)] + [(2, k) for k in range(6, min(hi, 29) + 1)]
    base = str(tmp_path / "grown")
    assert run(spark, store, base, end=12)[0] == [(c, k) for c in (1, 2) for k in range(13)]
    assert run(spark, store, base, end=14)[0] == [(c, k) for c in (1, 2) for k in (13, 14)]
    with pytest.raises(Exception, match="lies before what chains 1, 2 have delivered"):
        run(spark, store, base, end=7)


def test_a_batch_that_failed_is_delivered_again_and_one_without_a_manifest_is_not_seen(spark, store, tmp_path):
    base = str(tmp_path / "q")
    store.append(made(spark, [1], range(0, 12)), "a")
    made(spark, [1], range(12, 15)).withColumn("block_bucket", F.lit(1)).write.partitionBy("chain_id", "block_bucket").parquet(f"{store.path}/batch=cut")
    stream = block_source.stream_store(spark, store.path, LOGS, width=10)

    def fails(df, i):
        raise RuntimeError("sink broke")

    with pytest.raises(Exception, match="sink broke"):
        sinks.run_available(stream, fails, f"{base}/checkpoint")
    got, n, _ = run(spark, store, base)
    assert got == [(1, k) for k in range(12)] and n == 24


def test_columns_may_be_fewer_and_in_any_order(spark, store, tmp_path):
    store.append(made(spark, [1], range(0, 12)), "a")
    stream = block_source.stream_store(spark, store.path, "address string, block_bucket long, chain_id int", width=10)
    sinks.run_available(stream, lambda df, i: sinks.write_batch(df, i, str(tmp_path / "out")), str(tmp_path / "c"))
    rows = spark.read.parquet(str(tmp_path / "out")).select("address", "block_bucket", "chain_id").collect()
    assert sorted(map(tuple, rows)) == sorted((f"a{k}", k // 10, 1) for k in range(12) for _ in range(2))
