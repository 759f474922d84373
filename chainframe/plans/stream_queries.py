"""Queries of streaming operators: each writes its input as files, runs the stream over what is there, and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.fixtures import Fixtures
from chainframe.plans.match_queries import CHILDREN, LOG, as_contract, factories
from chainframe.plans.registry import register
from chainframe.plans.summary_queries import CANONICAL
from chainframe.scratch import scratch
from chainframe.sources.manifest import Store
from chainframe.streaming import block_source, reconcile, sinks

LOG_SCHEMA = "chain_id bigint, seq bigint, place int, event string, number bigint, hash string"


def folder(f: Fixtures) -> str:
    return f"{scratch(f.spark)}/{uuid.uuid4().hex}"


#: Blocks of a chain of the streams' items. The cuts lie far from numbers that forks begin at.
CHAIN_BLOCKS = 750
CHAIN = f"CAST(floor(({{}} + 124) / {CHAIN_BLOCKS}.0) AS BIGINT)"


def heads_of(f: Fixtures, where: str, seq: str, number: str) -> DataFrame:
    """Finalised heads after events that ``where`` picks."""
    n = "(event_id + 1)"
    return f.events.where(where).selectExpr(f"{CHAIN.format(n)} AS chain_id", f"CAST({seq} AS BIGINT) AS seq", "'final' AS kind", f"CAST({n} AS BIGINT) AS number", "CAST(NULL AS STRING) AS hash", "CAST(NULL AS STRING) AS parent_hash", f"CAST({number} * 12 AS BIGINT) AS at_s")


def items(f: Fixtures) -> DataFrame:
    """Deliveries as items of several chains, a stretch of blocks each, and a finalised head after every hundredth block,
    twenty blocks late."""
    d = f.deliveries.selectExpr(f"{CHAIN.format('number')} AS chain_id", "CAST(seq AS BIGINT) AS seq", "'block' AS kind", "CAST(number AS BIGINT) AS number", "hash", "parent_hash", "CAST(number * 12 AS BIGINT) AS at_s")
    return d.unionByName(heads_of(f, "(event_id + 1) % 100 = 0", "(event_id + 21) * 10 + 9", "(event_id + 21)"))


def written_items(f: Fixtures, rows: DataFrame, base: str) -> DataFrame:
    """A stream of ``rows``, which are written first."""
    reconcile.use_rocksdb(f.spark)
    reconcile.ordered_items(rows, f"{base}/in", together=True)
    return sinks.stream_blocks(f.spark, f"{base}/in", reconcile.ITEM, files_per_batch=reconcile.BATCH_FILES)


def reconciled(f: Fixtures, rows: DataFrame, **limits) -> DataFrame:
    """All events of ``rows`` through the stream."""
    base = folder(f)
    stream = reconcile.stream_reconcile(written_items(f, rows, base), **limits)
    sinks.run_available(stream, lambda df, i: sinks.write_batch(df, i, f"{base}/log"), f"{base}/checkpoint")
    return sinks.log_of(f.spark, f"{base}/log", LOG_SCHEMA).drop("batch_id")


def stream_blocks(f: Fixtures) -> DataFrame:
    base = folder(f)
    items(f).where("kind = 'block'").write.parquet(f"{base}/in")
    stream = sinks.stream_blocks(f.spark, f"{base}/in", reconcile.ITEM, last=50, end=700)
    sinks.run_available(stream, lambda df, i: sinks.write_batch(df, i, f"{base}/out"), f"{base}/checkpoint")
    return f.spark.read.schema(reconcile.ITEM).parquet(f"{base}/out").select("seq", "number", "hash")


register("stream_blocks", stream_blocks, "SELECT seq, number, hash FROM {deliveries} WHERE number > 50 AND number <= 700")

def resumed(f: Fixtures) -> DataFrame:
    """Logs of a store that grows between two runs of one query, each chain resumed at its own last block; chain 1 is known
    up to block 20."""
    base = folder(f)
    schema = "chain_id long, block_number long, log_index long, address string, topic0 string"
    store = Store(f.spark, f"{base}/store", schema, LOG)
    logs = f.logs.select(F.col("chain_id").cast("long").alias("chain_id"), *LOG[1:], "address", "topic0")
    for name, part in (("a", logs.where("block_number <= 40 + chain_id * 10")), ("b", logs.where("block_number > 40 + chain_id * 10"))):
        store.append(part, name)
        stream = block_source.stream_store(f.spark, f"{base}/store", schema, after={1: 20})
        sinks.run_available(stream, lambda df, i: sinks.write_batch(df, i, f"{base}/out"), f"{base}/checkpoint")
    return sinks.log_of(f.spark, f"{base}/out", schema).select(*LOG, "address", "batch_id")


register("stream_store", resumed, """
SELECT chain_id, block_number, log_index, address, CASE WHEN block_number <= 40 + chain_id * 10 THEN 0 ELSE 1 END AS batch_id FROM {logs} WHERE chain_id <> 1 OR block_number > 20""")

LIVE = f"SELECT {CHAIN.format('number')} AS chain_id, number, hash FROM ({CANONICAL}) c WHERE NOT orphaned"
register("stream_reconcile", lambda f: sinks.live_blocks(reconciled(f, items(f))).select("chain_id", "number", "hash"), LIVE)

register(
    "stream_finalize",
    lambda f: reconcile.stream_finalize(reconciled(f, items(f))).select("chain_id", "event", "number", "hash"),
    f"""
SELECT {CHAIN.format("number")} AS chain_id, 'finalize' AS event, number, md5(concat('c', CAST(number AS STRING))) AS hash
FROM (SELECT event_id + 1 AS number FROM {{events}} WHERE (event_id + 1) % 100 = 0) n""",
)


def rolled_back(f: Fixtures) -> DataFrame:
    """The log of appends and removals, as a live query writes it."""
    base = folder(f)
    sinks.run_available(reconcile.stream_reconcile(written_items(f, items(f), base)), sinks.stream_rollback(f"{base}/log", every=2), f"{base}/checkpoint")
    return sinks.rolled(f.spark, f"{base}/log", every=2)


def stream_rollback(f: Fixtures) -> DataFrame:
    payload = f.deliveries.selectExpr(f"{CHAIN.format('number')} AS chain_id", "hash AS block_hash", "number").distinct()
    return sinks.live_rows(payload, rolled_back(f)).select("chain_id", "block_hash", "number")


register("stream_rollback", stream_rollback, f"SELECT {CHAIN.format('number')} AS chain_id, hash AS block_hash, number FROM ({CANONICAL}) c WHERE NOT orphaned")


def pruned_live(f: Fixtures) -> DataFrame:
    """Children found in each seventh block, forks' blocks included; what a reorganisation removed goes with its block."""
    found = f.deliveries.where("number % 7 < 3").selectExpr(f"{CHAIN.format('number')} AS chain_id", "concat('0x', CAST(number % 97 AS STRING), substring(hash, 1, 1)) AS child", "number AS created_block", "hash AS block_hash")
    return sinks.live_children(found, rolled_back(f))


register("stream_prune_children_live", pruned_live, f"""
SELECT chain_id, child, min(number) AS created_block
FROM (SELECT {CHAIN.format("number")} AS chain_id, '0x' || CAST(number % 97 AS STRING) || substring(hash, 1, 1) AS child, number FROM ({CANONICAL}) c WHERE NOT orphaned AND number % 7 < 3) k GROUP BY chain_id, child""")


def stream_children(f: Fixtures) -> DataFrame:
    base = folder(f)
    logs = as_contract(f.logs).select(*LOG, "address", "topic0", "topic1", "data")
    logs.write.parquet(f"{base}/in")
    stream = f.spark.readStream.schema(logs.schema).parquet(f"{base}/in")
    sinks.run_available(stream, sinks.stream_children(factories(f), f"{base}/children", f"{base}/out"), f"{base}/checkpoint")
    return f.spark.read.parquet(f"{base}/out").select(*LOG, "address")


register("stream_children", stream_children, f"""
SELECT l.chain_id, l.block_number, l.log_index, l.address FROM {{logs}} l JOIN ({CHILDREN}) c ON c.chain_id = l.chain_id AND c.child = l.address AND l.block_number >= c.created_block""")

register(
    "stream_prune_children",
    lambda f: sinks.stream_prune_children(f.creations, f.heads.where("chain_id <> 2").select("chain_id", (F.col("chain_id") * 10).alias("number"))),
    "SELECT chain_id, child, created_block FROM {creations} WHERE chain_id = 2 OR created_block <= chain_id * 10",
)


def stream_dedupe(f: Fixtures) -> DataFrame:
    base = folder(f)
    one = f.tx.select("chain_id", "tx_hash", F.timestamp_seconds(1700000000 + F.col("block_number") * 12).alias("at"))
    one.unionByName(one.where("chain_id = 3")).write.parquet(f"{base}/in")
    stream = sinks.stream_dedupe(f.spark.readStream.schema(one.schema).parquet(f"{base}/in"), ["chain_id", "tx_hash"], "at", "3650 days")
    sinks.run_available(stream, lambda df, i: sinks.write_batch(df, i, f"{base}/out"), f"{base}/checkpoint")
    return f.spark.read.parquet(f"{base}/out").select("chain_id", "tx_hash")


register("stream_dedupe", stream_dedupe, "SELECT chain_id, tx_hash FROM {tx}")


def withheld_items(f: Fixtures) -> DataFrame:
    """All deliveries; of every 1,000 numbers blocks 501 to 599 come only after every tenth of them was a finalised head."""
    blocks = items(f).where("kind = 'block'").withColumn("seq", F.col("seq") * 1000)
    n = "(event_id + 1)"
    return blocks.unionByName(heads_of(f, f"{n} % 1000 BETWEEN 501 AND 599 AND event_id % 10 = 0", f"({n} - {n} % 1000) * 10000 + 5009000 + {n} % 1000", n))


def stalls(f: Fixtures) -> DataFrame:
    return reconcile.stream_progress_watchdog(reconciled(f, withheld_items(f), fail=False, stall_seconds=300)).select("number")


# the last delivery before the heads of a span is its block 500
STALLS = """
SELECT event_id + 1 AS number FROM {events} WHERE (event_id + 1) % 1000 BETWEEN 516 AND 599 AND event_id % 10 = 0 AND ((event_id + 1) % 1000 - 500) * 12 >= 300"""
register("stream_progress_watchdog", stalls, STALLS)
register("stream_progress_watchdog_all", stalls, STALLS)


def stream_finalized_children(f: Fixtures) -> DataFrame:
    base = folder(f)
    c = f.creations.select(F.lit("vault").alias("factory"), F.col("chain_id").cast("long").alias("chain_id"), F.col("child").alias("address"), F.col("created_block").cast("long").alias("created_block"))
    schema = "factory string, chain_id bigint, address string, created_block bigint"
    for part in (c.withColumn("created_block", F.col("created_block") + F.col("created_block") % 2), c):
        part.write.mode("append").parquet(f"{base}/in")
        stream = f.spark.readStream.schema(schema).parquet(f"{base}/in")
        sinks.run_available(stream, sinks.stream_finalized_children(f"{base}/out"), f"{base}/checkpoint")
    return sinks.log_of(f.spark, f"{base}/out", schema).select("chain_id", "address", "created_block", "batch_id")


register("stream_finalized_children", stream_finalized_children, """
SELECT chain_id, child AS address, created_block + created_block % 2 AS created_block, 0 AS batch_id FROM {creations}
UNION ALL SELECT chain_id, child, created_block, 1 FROM {creations} WHERE created_block % 2 = 1""")

register(
    "stream_freshness",
    lambda f: sinks.stream_freshness(
        f.requests.select(F.col("at_s").alias("batch_id"), (F.col("at_s") * 1000).alias("at_ms")),
        f.requests.where("at_s % 7 <> 0").select(F.col("at_s").alias("batch_id"), (F.col("at_s") * 1000 + F.col("bytes") % 500).alias("at_ms"), (F.col("ok") == 1).alias("ok")),
    ),
    """
SELECT at_s AS batch_id, at_s * 1000 AS received_ms, CASE WHEN at_s % 7 <> 0 THEN at_s * 1000 + bytes % 500 END AS committed_ms, CASE WHEN at_s % 7 <> 0 THEN bytes % 500 END AS latency_ms,
       CASE WHEN at_s % 7 = 0 THEN 'pending' WHEN ok = 1 THEN 'ack' ELSE 'reject' END AS state FROM {requests}""",
)


def fresh_run(f: Fixtures) -> DataFrame:
    """Batches of a stream over all deliveries, by what the run itself recorded."""
    base = folder(f)
    f.deliveries.selectExpr("seq", "number", "hash").repartition(4).write.parquet(f"{base}/in")
    stream = sinks.stream_blocks(f.spark, f"{base}/in", "seq bigint, number bigint, hash string", files_per_batch=1)
    sinks.run_available(stream, sinks.recorded(lambda df, i: sinks.write_batch(df, i, f"{base}/out"), f"{base}/times"), f"{base}/checkpoint")
    rows = sinks.log_of(f.spark, f"{base}/out", "seq bigint, number bigint, hash string").agg(F.count("*").alias("n_rows"))
    timed = sinks.freshness_of(f.spark, f"{base}/times").select("state", (F.col("latency_ms") >= 0).alias("timed"))
    return timed.groupBy("state").agg(F.count("*").alias("batches"), F.bool_and("timed").alias("timed")).join(F.broadcast(rows))


register("stream_freshness_live", fresh_run, "SELECT 'ack' AS state, 4 AS batches, TRUE AS timed, (SELECT count(*) FROM {deliveries}) AS n_rows")
