"""Block buckets and reproducible windows of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_bucket(block: Column, width: int, lo: int | None = None, hi: int | None = None) -> Column:
    """The bucket of a block; the bucket of its nearest block within lo..hi if these are given."""
    if lo is not None:
        block = F.greatest(block, F.lit(lo))
    if hi is not None:
        block = F.least(block, F.lit(hi))
    return F.floor(block / F.lit(width)).cast("long")


#: Blocks of chain 1 from which on its rows look different.
ERAS = {"preByzantiumReceipts": 4_200_000, "merge": 15_537_393, "blobType3": 19_426_587, "type4Prague": 22_431_084}


def sample_windows(chains: DataFrame, seed: int, count: int, length: int, grid: int = 500_000, delta: int = 2, pad: int = 100, span: int = 50, frontier: int = 30, eras: dict[str, int] = ERAS, era_chain: int = 1) -> DataFrame:
    """Windows of blocks per chain (chain_id, first_block, last_block, deploy_block), with the strategy that made them:
    ``count`` seeded random ones of ``length`` blocks, ``delta`` around each multiple of ``grid``, ``pad`` around the
    deployment, ``span`` blocks from the start of each era of ``era_chain``, the last ``frontier`` blocks, and all since the
    deployment. They are cut to the chain's blocks; what lies outside is left out.

    Random starts come from MD5 of seed, chain and number, so they are the same everywhere.
    """
    first, last, deploy = F.col("first_block"), F.col("last_block"), F.col("deploy_block")
    room = F.greatest(last - first - length + 2, F.lit(1))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("chain_id").cast("string"), F.col("i").cast("string")).cast("binary"))
    at = first + F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), room)
    keep = ["chain_id", "first_block", "last_block"]

    def rows(df: DataFrame, name, lo, hi) -> DataFrame:
        return df.select(*keep, (F.lit(name) if isinstance(name, str) else name).alias("strategy"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))

    random = chains.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    low, high = F.ceil((first + delta) / grid), F.floor((last - delta) / grid)
    edges = chains.where(low <= high).withColumn("edge", F.explode(F.sequence(low, high))).withColumn("edge", F.col("edge") * grid)
    era = chains.where(F.col("chain_id") == era_chain).withColumn("era", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(b).cast("long").alias("block")) for n, b in eras.items()))))
    parts = [
        rows(random, F.concat(F.lit("random-"), F.col("i").cast("string")), at, at + length - 1),
        rows(edges, F.concat(F.lit("grid@"), F.col("edge").cast("string")), F.col("edge") - delta, F.col("edge") + delta),
        rows(era, F.concat(F.lit("era:"), F.col("era.name")), F.col("era.block"), F.col("era.block") + span),
        rows(chains, "deploy", F.greatest(deploy - pad, F.lit(0)), deploy + pad),
        rows(chains, "frontier", last - frontier + 1, last),
        rows(chains, "full", deploy, last),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("chain_id", "strategy", F.greatest("lo", "first_block").alias("lo"), F.least("hi", "last_block").alias("hi")).where("lo <= hi")
