"""Rows to write to the store: idempotent appends and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def write_store(df: DataFrame, target: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key the target lacks, one for each key (the first in ``order``, or any)."""
    if order:
        w = Window.partitionBy(*keys).orderBy(*order)
        one = df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    else:
        one = df.dropDuplicates(keys)
    return one.join(target.select(*keys), keys, "left_anti").select(*df.columns)


def append_store(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Append to the parquet table at ``path`` what it lacks, and return those rows. Writing again writes nothing."""
    spark = df.sparkSession
    try:
        target = spark.read.schema(df.schema).parquet(path)
    except Exception as error:  # the first write
        if "PATH_NOT_FOUND" not in str(error):
            raise
        target = spark.createDataFrame([], df.schema)
    new = write_store(df, target, keys, order)
    new.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)
    return new


def merge_sources(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of rows from several sources, one for each key; earlier sources win."""
    out = None
    for k, part in enumerate(parts):
        own = part.withColumn("__source", F.lit(k))
        out = own if out is None else out.unionByName(own)
    w = Window.partitionBy(*keys).orderBy("__source")
    return out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__source")


def upsert_do_nothing(events: DataFrame, existing: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows to insert: the first event of each key that doesn't exist yet."""
    columns = [c for c in events.columns if c not in keys]
    first = events.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("v")).select(*keys, "v.*")
    return first.join(existing.select(*keys), keys, "left_anti").select(*events.columns)


def upsert_accumulate(events: DataFrame, existing: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Existing counters plus one for each event; keys of either side. It keeps no account of what it counted: where batches
    may be repeated or blocks removed, see ledger_entries."""
    new = events.groupBy(*keys).agg(F.count("*").alias("__new"))
    return existing.select(*keys, count).join(new, keys, "full_outer").select(
        *keys, (F.coalesce(count, F.lit(0)) + F.coalesce("__new", F.lit(0))).cast("long").alias(count)
    )


def ledger_entries(events: DataFrame, removed: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Signed entries (keys, chain_id, block_hash, delta) of a batch against the ``ledger`` of batches before it.

    ``events`` (keys, chain_id, block_hash) count one each. A block that the ledger counts already adds nothing, so a
    redelivered block is no-op; ``removed`` (chain_id, block_hash) blocks, of this batch or of earlier ones, are taken back.
    A block that comes back after it was removed counts again.
    """
    block = ["chain_id", "block_hash"]
    gone = removed.select(*block).distinct()
    held = ledger.groupBy(*keys, *(b for b in block if b not in keys)).agg(F.sum("delta").alias("delta")).where("delta <> 0")
    own = events.groupBy(*keys, *(b for b in block if b not in keys)).agg(F.count("*").alias("delta"))
    new = own.join(gone, block, "left_anti").join(held.select(*block).distinct(), block, "left_anti")
    undone = held.join(gone, block, "left_semi").withColumn("delta", -F.col("delta"))
    columns = list(dict.fromkeys([*keys, *block])) + ["delta"]
    return new.select(*columns).unionByName(undone.select(*columns))


def post_batch(events: DataFrame, removed: DataFrame, path: str, batch_id: int, keys: list[str]) -> None:
    """Write a batch's entries to its own folder of the ledger at ``path``. A batch that runs again, even after later ones,
    is worked out against the batches before it alone, and so writes the same."""
    spark = events.sparkSession
    columns = list(dict.fromkeys([*keys, "chain_id", "block_hash"]))
    schema = events.select(*columns).schema.add("delta", "long")
    ledger = read_ledger(spark, path, schema).where(F.col("batch_id") < batch_id).drop("batch_id")
    ledger_entries(events, removed, ledger, keys).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_ledger(spark, path: str, schema) -> DataFrame:
    """All entries with their batch_id; none before the first batch."""
    whole = StructType([*schema.fields, StructField("batch_id", LongType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], whole)


def ledger_totals(ledger: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Counters (keys, n) as the ledger's entries add up; keys whose events were all taken back are gone."""
    return ledger.groupBy(*keys).agg(F.sum("delta").cast("long").alias(count)).where(F.col(count) != 0)


def completion_summary(metrics: DataFrame) -> DataFrame:
    """Metrics (chain, name, value) as one row per chain, and a row for all (chain null).

    complete: completed equals total, and both are there. Names: completed, total, start, end, errors.
    """

    def of(name: str):
        return F.when(F.col("name") == name, F.col("value"))

    per = metrics.groupBy("chain").agg(
        F.max(of("completed")).alias("completed"), F.max(of("total")).alias("total"),
        F.min(of("start")).alias("start_s"), F.max(of("end")).alias("end_s"), F.coalesce(F.sum(of("errors")), F.lit(0)).alias("errors"),
    ).withColumn("complete", F.coalesce(F.col("completed") == F.col("total"), F.lit(False)))
    cols = ["complete", "completed", "total", "start_s", "end_s", "errors"]
    everything = per.agg(
        F.coalesce(F.bool_and("complete"), F.lit(False)).alias("complete"), F.sum("completed").alias("completed"), F.sum("total").alias("total"),
        F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.sum("errors").alias("errors"),
    ).withColumn("chain", F.lit(None).cast(per.schema["chain"].dataType))
    return per.select("chain", *cols).unionByName(everything.select("chain", *cols)).withColumn("wall_s", F.col("end_s") - F.col("start_s"))


def run_metrics(families: dict[str, DataFrame], ranges: DataFrame) -> DataFrame:
    """Per chain: rows written of each family, ranges served and deferred, bytes.

    ``ranges``: chain_id, state ('served' or 'deferred'), bytes.
    """
    parts = [df.groupBy("chain_id").agg(F.count("*").alias("n")).withColumn("family", F.lit(name)) for name, df in families.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    by = rows.groupBy("chain_id").agg(*(F.coalesce(F.sum(F.when(F.col("family") == n, F.col("n"))), F.lit(0)).alias(f"{n}_rows") for n in families))
    r = ranges.groupBy("chain_id").agg(
        F.count_if(F.col("state") == "served").alias("served_ranges"),
        F.count_if(F.col("state") == "deferred").alias("deferred_ranges"),
        F.sum("bytes").alias("bytes"),
    )
    out = by.join(r, "chain_id", "full_outer")
    return out.select("chain_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in out.columns if c != "chain_id"))


def write_observed(families: dict[str, DataFrame], path: str, chains: list[int]) -> DataFrame:
    """Write each family to its folder at ``path``, by chain, and give back (chain_id, NAME_rows ...) as it was counted while
    the rows went by: nothing is read again. ``chains`` are those of the configuration; rows of another chain are an error.
    The chain stays the column that it is, so that rows which come sorted by it aren't sorted again to be written by chain."""
    if not families:
        raise ValueError("no families")
    spark = next(iter(families.values())).sparkSession
    seen: dict[str, dict] = {}
    for name, df in families.items():
        o = Observation(name)
        known = F.when(F.col("chain_id").isin(chains), F.col("chain_id").cast("long")).otherwise(F.raise_error(F.concat(F.lit("unknown chain "), F.coalesce(F.col("chain_id").cast("string"), F.lit("null")))).cast("long"))
        own = df if df.schema["chain_id"].dataType.simpleString() == "bigint" else df.withColumn("chain_id", F.col("chain_id").cast("long"))
        own.observe(o, F.count(known).alias("known"), *(F.count_if(F.col("chain_id") == c).alias(f"n{c}") for c in chains)).write.partitionBy("chain_id").parquet(f"{path}/{name}")
        seen[name] = o.get
    rows = [(c, *(int(seen[name][f"n{c}"]) for name in families)) for c in chains]
    return spark.createDataFrame(rows, ", ".join(["chain_id long", *(f"{name}_rows long" for name in families)]))
