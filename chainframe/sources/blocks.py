"""Reading raw blocks, ranges of them, and their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.schemas import FAMILIES, NULLABLE_COLUMNS, RAW_BLOCK

#: Blocks of a partition of a store.
BUCKET = 1000
#: Ranges that become one condition on a scan.
MOST_RANGES = 500


def read_block_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """One row per block of newline JSON, plain or gzipped; a malformed line is an error."""
    return spark.read.schema(RAW_BLOCK).option("mode", "FAILFAST").json(path)


def explode_block(blocks: DataFrame) -> dict[str, DataFrame]:
    """Headers, logs, transactions and traces of raw blocks, each with its block's number, hash and timestamp.

    Other columns of ``blocks`` (such as chain_id) stay. Absent arrays give no rows.
    """
    keep = [c for c in blocks.columns if c not in ("header", "logs", "transactions", "traces")]
    own = [*keep, F.col("header.number").alias("block_number"), F.col("header.hash").alias("block_hash"), F.col("header.timestamp").alias("block_ts")]
    out = {"headers": blocks.select(*keep, "header.*")}
    for name in ("logs", "transactions", "traces"):
        out[name] = blocks.select(*own, F.inline(name))
    return out


def scan_range(df: DataFrame, lo: int, hi: int, column: str = "block_number") -> DataFrame:
    """Rows with lo <= block <= hi; the bounds reach the files' statistics."""
    return df.where(F.col(column).between(lo, hi))


def bounded_window(filters: DataFrame, finalized: DataFrame) -> DataFrame:
    """Per chain the blocks that its filters want: from the least start (0 if any is open) to the greatest end (open if
    any is), at most the finalized head."""
    wanted = filters.groupBy("chain_id").agg(
        F.when(F.count_if(F.col("from_block").isNull()) > 0, F.lit(0)).otherwise(F.min("from_block")).cast("long").alias("start_block"),
        F.when(F.count_if(F.col("to_block").isNull()) == 0, F.max("to_block")).cast("long").alias("wanted_end"),
    )
    heads = finalized.select("chain_id", F.col("finalized").cast("long").alias("finalized"))
    return wanted.join(heads, "chain_id", "left").select("chain_id", "start_block", F.least("wanted_end", "finalized").alias("end_block"))


def scan_windows(df: DataFrame, ranges: DataFrame, partitions: DataFrame, width: int = BUCKET) -> DataFrame:
    """Rows of a store partitioned by chain_id and block_bucket that lie in the partitions of ``ranges`` (chain_id, lo, hi;
    null is open), so that a scan reads no others.

    ``partitions`` (chain_id, block_bucket) are those that the store has, such as Store.partitions: they bound open ranges.
    What is sent to prune the scan has a row for each of them at most. Spark prunes by each column on its own then, so up to
    MOST_RANGES ranges are a condition on both columns as well.
    """
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    r = ranges.select(F.col("chain_id").alias("r_chain"), bucket("lo").alias("first"), bucket("hi").alias("last"))
    inside = (F.col("chain_id") == F.col("r_chain")) & (F.col("first").isNull() | (F.col("block_bucket") >= F.col("first"))) & (F.col("last").isNull() | (F.col("block_bucket") <= F.col("last")))
    few = r.distinct().limit(MOST_RANGES + 1).collect()
    if len(few) <= MOST_RANGES:
        both = [f"(chain_id = {x.r_chain}" + f" AND block_bucket >= {x.first}" * (x.first is not None) + f" AND block_bucket <= {x.last}" * (x.last is not None) + ")" for x in few if x.r_chain is not None]
        df = df.where(" OR ".join(both) or "false")
    wanted = partitions.where("block_bucket >= 0").join(F.broadcast(r.distinct()), inside, "left_semi").select("chain_id", "block_bucket")
    return df.join(F.broadcast(wanted), ["chain_id", "block_bucket"], "left_semi").select(*df.columns)


def project_families(tables: dict[str, DataFrame], sources: set[str], want_receipts: bool = False) -> dict[str, DataFrame]:
    """The families that ``sources`` (log, transaction, trace, transfer, block) need, each with its own columns only, so
    that scans read no others. Headers are needed by all, transactions by all but block sources. A receipt's columns come
    with transactions if a source wants receipts, and always if transactions are a source themselves."""
    needed = {"blocks"} | ({"logs"} if "log" in sources else set()) | ({"traces"} if sources & {"trace", "transfer"} else set()) | ({"transactions"} if sources - {"block"} else set())
    receipts = FAMILIES["receipts"] if want_receipts or "transaction" in sources else ()
    out = {}
    for name in sorted(needed & set(tables)):
        wanted = {"chain_id", *FAMILIES[name], *(receipts if name == "transactions" else ())}
        out[name] = tables[name].select(*(c for c in tables[name].columns if c in wanted))
    return out


def degrade_columns(parts: list[DataFrame], columns: dict[str, str]) -> DataFrame:
    """One table of ``columns`` (name -> type) from ranges that may lack some; what a range lacks is null there.

    Only nullable columns may be lacking.
    """
    out = None
    for part in parts:
        lacking = [c for c in columns if c not in part.columns and c not in NULLABLE_COLUMNS]
        if lacking:
            raise ValueError(f"required columns are missing: {lacking}")
        own = part.select(*((F.col(c) if c in part.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()))
        out = own if out is None else out.unionByName(own)
    return out


def assert_needed_columns(df: DataFrame, matched: str, columns: list[str]) -> DataFrame:
    """``df``'s rows that ``matched`` holds for; a needed column that the range lacks is an error if there are any."""
    lacking = [c for c in columns if c not in df.columns]
    found = df.where(matched)
    if not lacking:
        return found
    return found.where(F.raise_error(F.lit(f"matched rows need missing columns: {lacking}")).isNull())


def column_availability(df: DataFrame, columns: list[str], width: int = 1000) -> DataFrame:
    """Per chain, column and block bucket the share of nulls, with the column's first served block and its class on the
    chain: full, from-block or absent."""
    long = df.select("chain_id", "block_number", F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).isNotNull().alias("there")) for c in columns))))
    buckets = long.groupBy("chain_id", "column_name", F.floor(F.col("block_number") / width).alias("bucket")).agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("there")).alias("nulls"),
        F.min(F.when(F.col("there"), F.col("block_number"))).alias("first_there"),
        F.min("block_number").alias("first_block"),
    )
    total = buckets.groupBy("chain_id", "column_name").agg(
        F.min("first_there").alias("first_served"), F.sum("nulls").alias("all_nulls"), F.min("first_block").alias("chain_first")
    )
    kind = F.when(F.col("first_served").isNull(), "absent").when(F.col("first_served") > F.col("chain_first"), "from-block").otherwise("full")
    return buckets.join(total, ["chain_id", "column_name"]).select(
        "chain_id", "column_name", "bucket", F.round(F.col("nulls") / F.col("n"), 6).alias("null_share"), "first_served", kind.alias("availability")
    )


def unserved_prefix(requests: DataFrame, dataset_start: DataFrame) -> DataFrame:
    """Requests (chain_id, from_block, to_block) against data sets' first blocks: the part before, and where to go on."""
    j = requests.join(dataset_start, "chain_id", "left").withColumn("first", F.coalesce("dataset_start", "from_block"))
    gap = F.col("first") > F.col("from_block")
    return j.select(
        "chain_id",
        F.when(gap, F.col("from_block")).alias("unserved_from"),
        F.when(gap, F.least(F.col("first") - 1, F.col("to_block"))).alias("unserved_to"),
        F.when(F.col("first") <= F.col("to_block"), F.greatest("from_block", "first")).alias("continue_from"),
    )


def finality_split(ranges: DataFrame, heads: DataFrame) -> DataFrame:
    """Ranges (chain_id, lo, hi) against heads (chain_id, finalized, head, floor_block): what is served and what is deferred.

    The boundary is the lesser of finalized and head, raised to the persisted floor, never above finalized. Without a
    known head everything is deferred.
    """
    j = ranges.join(heads, "chain_id", "left")
    edge = F.when(
        F.col("finalized").isNotNull() & F.col("head").isNotNull(),
        F.least(F.greatest(F.least("finalized", "head"), F.coalesce("floor_block", F.lit(0))), F.col("finalized")),
    )
    j = j.withColumn("edge", edge)
    none = F.col("edge").isNull() | (F.col("edge") < F.col("lo"))
    all_ = ~none & (F.col("edge") >= F.col("hi"))
    return j.select(
        "chain_id", "lo", "hi",
        F.when(~none, F.col("lo")).alias("served_lo"),
        F.when(~none, F.least("edge", "hi")).alias("served_hi"),
        F.when(none, F.col("lo")).when(~all_, F.col("edge") + 1).alias("deferred_lo"),
        F.when(none | ~all_, F.col("hi")).alias("deferred_hi"),
        F.when(none, "deferred").when(all_, "served").otherwise("split").alias("state"),
    )
