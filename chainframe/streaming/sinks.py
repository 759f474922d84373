"""Streaming sources and foreachBatch sinks.

A sink's folder is a log: each batch writes its own ``batch_id`` partition and overwrites it when it runs again, so every
row counts once. Rollbacks are rows too; readers take each block's last word. Nothing that was written is rewritten.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainframe.operators.filters import child_logs
from chainframe.operators.joins import dedupe_children_least, discover_children


def stream_blocks(spark: SparkSession, path: str, schema: str, form: str = "parquet", last: int | None = None, end: int | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Streaming rows of ``path``; resumes by its query's checkpoint, or after block ``last``; ends at block ``end``."""
    reader = spark.readStream.schema(schema).format(form)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if form == "json":
        reader = reader.option("mode", "FAILFAST")
    df = reader.load(path)
    number = "header.number" if "header" in df.columns else "number"
    if last is not None:
        df = df.where(F.col(number) > last)
    return df if end is None else df.where(F.col(number) <= end)


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """The batch's partition of the log at ``path``, replaced if it is there."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def log_of(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches; none before the first."""
    try:
        return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], f"{schema}, batch_id bigint")


#: Batches after which what they say is written as one table; so many tables of one size are merged into the next.
COMPACT = 20


def _batches(spark: SparkSession, path: str, schema: str, ids: range) -> DataFrame:
    """The batches ``ids``, by their folders' names: others are not even listed. Batches that wrote nothing are passed over."""
    if not ids:
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(*(f"{path}/batch_id={k}" for k in ids))
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return log_of(spark, path, schema).where(F.col("batch_id").between(ids[0], ids[-1])).drop("batch_id")


def _span(end: int, every: int) -> int:
    """Batches in the table that the batch before ``end`` wrote: the highest power of ``every`` that divides ``end``."""
    span = every
    while every > 1 and end % (span * every) == 0:
        span *= every
    return span


def _said(spark: SparkSession, path: str, schema: str, start: int, end: int, every: int) -> DataFrame:
    """Rows of the batches from ``start`` up to ``end``, from as few tables as hold them and the batches since the last."""
    top = max(start, end // every * every)
    out, tables, at = _batches(spark, path, schema, range(top, end)), [], top
    while at > start:
        tables.append(f"{path}-whole/{at - 1}")
        at -= _span(at, every)
    return spark.read.schema(schema).parquet(*tables).unionByName(out) if tables else out


def state_before(spark: SparkSession, path: str, schema: str, batch_id: int, every: int = COMPACT) -> DataFrame:
    """What the log says before a batch: tables of powers of ``every`` batches, and the batches since; fewer than ``every`` of
    each size are read. A key may be in several of them."""
    return _said(spark, path, schema, 0, batch_id, every)


def compact(spark: SparkSession, path: str, schema: str, batch_id: int, merged: Callable[[DataFrame], DataFrame], every: int = COMPACT) -> None:
    """Write what the batches since the last table of this size say as one table, ``merged``, if it is this batch's turn. A row
    is written again once for each power of ``every``, however long the log gets. A batch that runs again writes the same."""
    end = batch_id + 1
    if end % every:
        return
    span = _span(end, every)
    if span == every:
        own = _batches(spark, path, schema, range(end - span, end))
    else:  # what is merged are tables of the next smaller size; the last of them is made of this batch, too
        own = _said(spark, path, schema, end - span, end - every, every).unionByName(_batches(spark, path, schema, range(end - every, end)))
    merged(own).write.mode("overwrite").parquet(f"{path}-whole/{batch_id}")


def recorded(batch: Callable[[DataFrame, int], None], path: str) -> Callable[[DataFrame, int], None]:
    """``batch`` with its times in the logs at ``path``/received and ``path``/committed: see stream_freshness. A batch that
    fails is committed as not ok, and its error goes on."""

    def row(df: DataFrame, batch_id: int, kind: str, **more) -> None:
        now = df.sparkSession.range(1).select(F.lit(time.time_ns() // 1_000_000).alias("at_ms"), *(F.lit(v).alias(k) for k, v in more.items()))
        write_batch(now, batch_id, f"{path}/{kind}")

    def run(df: DataFrame, batch_id: int) -> None:
        row(df, batch_id, "received")
        try:
            batch(df, batch_id)
        except Exception:
            row(df, batch_id, "committed", ok=False)
            raise
        row(df, batch_id, "committed", ok=True)

    return run


def freshness_of(spark: SparkSession, path: str) -> DataFrame:
    """stream_freshness of what ``recorded`` wrote."""
    return stream_freshness(log_of(spark, f"{path}/received", "at_ms bigint"), log_of(spark, f"{path}/committed", "at_ms bigint, ok boolean"))


def run_available(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run the batches that are there, and stop."""
    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def stream_rollback(path: str, every: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """Sink of reconciled events: appends and removals of blocks. Each ``every`` batches their last words are written as one
    table, and ``every`` of these as a larger one. Read it with rolled and live_blocks."""

    def batch(df: DataFrame, batch_id: int) -> None:
        write_batch(df.where(F.col("event").isin("append", "remove")).select(*(F.col(c) for c in ROLLED_COLUMNS)), batch_id, path)
        compact(df.sparkSession, path, ROLLED, batch_id, last_words, every)

    return batch


ROLLED = "chain_id bigint, seq bigint, place int, event string, number bigint, hash string"
ROLLED_COLUMNS = ("chain_id", "seq", "place", "event", "number", "hash")


def last_words(log: DataFrame) -> DataFrame:
    """The last append or removal of each block."""
    last = log.where(F.col("event").isin("append", "remove")).groupBy("chain_id", "number", "hash").agg(F.max(F.struct("seq", "place", "event")).alias("e"))
    return last.select("chain_id", "e.seq", "e.place", "e.event", "number", "hash")


def rolled(spark: SparkSession, path: str, every: int = COMPACT) -> DataFrame:
    """What stream_rollback's log says so far: its whole tables, and the batches since."""
    newest = log_of(spark, path, ROLLED).agg(F.max("batch_id")).first()[0]
    return state_before(spark, path, ROLLED, 0 if newest is None else newest + 1, every)


def live_blocks(log: DataFrame) -> DataFrame:
    """(chain_id, number, hash) of blocks whose last event is an append."""
    return last_words(log).where("event = 'append'").select("chain_id", "number", "hash")


def live_rows(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Payload rows (chain_id, block_hash) of live blocks."""
    live = live_blocks(log).select("chain_id", F.col("hash").alias("block_hash"))
    return rows.join(live, ["chain_id", "block_hash"], "left_semi").select(*rows.columns)


def live_children(children: DataFrame, log: DataFrame) -> DataFrame:
    """(chain_id, child, created_block) of children (with block_hash) whose creating block is live: what a reorganisation
    removed is pruned with the blocks it was found in, and comes back if the block does."""
    return live_rows(children, log).groupBy("chain_id", "child").agg(F.min("created_block").alias("created_block"))


def stream_children(factories: DataFrame, children_path: str, logs_path: str, location: str = "topic1", every: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """Sink of log batches: children found in a batch match logs of the same batch; each batch is done once. What is known
    is read from compacted tables and the batches since. The last batch's logs stay at ``logs_path``-batch."""
    schema, keys = "chain_id bigint, child string, created_block bigint", ["chain_id", "child"]

    def least(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.min("created_block").alias("created_block"))

    def batch(df: DataFrame, batch_id: int) -> None:
        # read twice, from files: a cached partition would be one task's read, however large it is unpacked
        df.write.mode("overwrite").parquet(f"{logs_path}-batch")
        df = df.sparkSession.read.schema(df.schema).parquet(f"{logs_path}-batch")
        own = least(discover_children(df, factories, location))
        write_batch(own.select(F.col("chain_id").cast("bigint"), "child", F.col("created_block").cast("bigint")), batch_id, children_path)
        mine = df.sparkSession.read.schema(schema).parquet(f"{children_path}/batch_id={batch_id}")
        known = least(state_before(df.sparkSession, children_path, schema, batch_id, every).unionByName(mine))
        write_batch(child_logs(df, known), batch_id, logs_path)
        compact(df.sparkSession, children_path, schema, batch_id, least, every)

    return batch


def stream_prune_children(children: DataFrame, reorgs: DataFrame) -> DataFrame:
    """Children (chain_id, child, created_block) without those created above their chain's common ancestor (reorgs:
    chain_id, number)."""
    least = reorgs.groupBy("chain_id").agg(F.min("number").alias("ancestor"))
    j = children.join(least, "chain_id", "left")
    return j.where("ancestor IS NULL OR created_block <= ancestor").select(*children.columns)


def stream_dedupe(stream: DataFrame, keys: list[str], at: str, delay: str = "1 day") -> DataFrame:
    """Each key once, such as transactions by hash: redelivered blocks do nothing. State is kept for ``delay`` of the time
    ``at`` behind the latest row; blocks that old are final and aren't delivered again."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def stream_finalized_children(path: str, every: int = COMPACT) -> Callable[[DataFrame, int], None]:
    """Sink of children (factory, chain_id, address, created_block) at finality: new ones, or known ones found earlier."""
    schema = "factory string, chain_id bigint, address string, created_block bigint"

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        stored = state_before(spark, path, schema, batch_id, every)
        write_batch(dedupe_children_least(df, stored), batch_id, path)
        compact(spark, path, schema, batch_id, lambda rows: rows.groupBy("factory", "chain_id", "address").agg(F.min("created_block").alias("created_block")), every)

    return batch


def stream_freshness(received: DataFrame, committed: DataFrame) -> DataFrame:
    """Batches (batch_id, at_ms) received and committed (batch_id, at_ms, ok): latency, and ack, reject or pending."""
    w = Window.partitionBy("batch_id").orderBy(F.desc("at_ms"))
    last = committed.withColumn("__n", F.row_number().over(w)).where("__n = 1").select("batch_id", F.col("at_ms").alias("committed_ms"), "ok")
    j = received.groupBy("batch_id").agg(F.min("at_ms").alias("received_ms")).join(last, "batch_id", "left")
    state = F.when(F.col("ok").isNull(), "pending").when(F.col("ok"), "ack").otherwise("reject")
    return j.select("batch_id", "received_ms", "committed_ms", (F.col("committed_ms") - F.col("received_ms")).alias("latency_ms"), state.alias("state"))
