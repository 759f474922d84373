"""A store whose batches are seen whole or not at all.

A batch is written to a folder of its own, by chain and block bucket. Then its manifest is written: the partitions that it
has, with their rows. A reader takes the folders of manifests that are there, so a batch that failed halfway, or that runs a
second time, leaves nothing to be seen. What a batch may repeat lies in the partitions that it touches: only those of earlier
batches are read to find out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chainframe.sources.blocks import BUCKET
from chainframe.sources.store import write_store

PARTITION = ["chain_id", "block_bucket"]
#: Tasks that list the folders of one chain; Spark's own number is a task for each folder, up to 10,000.
LISTERS = 32
#: Neighbouring buckets from which on a condition names the first and the last only.
RUN = 8
MANIFEST = "chain_id bigint, block_bucket bigint, n_rows bigint"


@contextmanager
def few_listers(spark: SparkSession) -> Iterator[None]:
    """Relations that are made within list their folders by LISTERS tasks a level, not by a task for each folder."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(key)
    spark.conf.set(key, str(min(LISTERS, int(old))))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def among(buckets: set[int]) -> Column:
    """Whether block_bucket is one of ``buckets``; long runs of them are bounds."""
    single, found, run = [], [], []
    for b in [*sorted(buckets), None]:
        if run and b != run[-1] + 1:
            if len(run) < RUN:
                single += run
            else:
                found.append(F.col("block_bucket").between(run[0], run[-1]))
            run = []
        run.append(b)
    if single:
        found.append(F.col("block_bucket").isin(single))
    return reduce(lambda a, b: a | b, found)


def batch_name(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
        raise ValueError(f"a batch's name has letters, digits, _ . and - only: {name}")
    return name


class Store:
    """The table of ``schema`` (with chain_id and block_number) at ``path``; ``keys`` tell its rows apart."""

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str], width: int = BUCKET):
        self.spark, self.path, self.schema, self.keys, self.width = spark, path.rstrip("/"), spark.createDataFrame([], schema).schema, keys, width
        self._listed: dict[tuple[str, ...], DataFrame] = {}  # a batch never changes once it is there, so its folders are listed once

    def manifest(self) -> DataFrame:
        """(chain_id, block_bucket, n_rows, batch) of every committed batch."""
        try:
            return self.spark.read.schema(f"{MANIFEST}, batch string").parquet(f"{self.path}/manifest")
        except Exception as error:  # before the first batch
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], f"{MANIFEST}, batch string")

    def partitions(self) -> DataFrame:
        """(chain_id, block_bucket) that the store has: what scan_windows and the filters take."""
        return self.manifest().select(*PARTITION).distinct()

    def _of(self, batches: list[str]) -> DataFrame:
        stored = StructType([f for f in self.schema.fields if f.name != "block_bucket"]).add("block_bucket", "long")
        if not batches:
            return self.spark.createDataFrame([], stored)
        own = tuple(batches)
        if own not in self._listed:
            with few_listers(self.spark):
                found = self.spark.read.schema(stored).option("basePath", self.path).parquet(*(f"{self.path}/batch={b}" for b in own))
            self._listed[own] = found.select(*stored.names)
        return self._listed[own]

    def batches(self) -> list[str]:
        return sorted(r.batch for r in self.manifest().select("batch").distinct().collect())

    def read(self) -> DataFrame:
        """All rows of committed batches, with block_bucket."""
        return self._of(self.batches())

    def lacking(self, df: DataFrame, order: list[str] | None = None) -> DataFrame:
        """Rows of ``df`` (with block_bucket) whose key the store lacks, one for each key. Of the store only partitions that
        ``df`` touches are read."""
        touched = df.select(*PARTITION).distinct()
        met = self.manifest().join(F.broadcast(touched), PARTITION, "left_semi")
        own = sorted({(r.chain_id, r.block_bucket, r.batch) for r in met.collect()})  # a batch's partitions, not its rows
        if not own:
            return write_store(df, df.limit(0), self.keys, order)
        pairs: dict[int, set[int]] = {}
        for chain, bucket, _ in own:
            pairs.setdefault(chain, set()).add(bucket)
        here = reduce(lambda a, b: a | b, [(F.col("chain_id") == c) & among(b) for c, b in pairs.items()])
        return write_store(df, self._of(sorted({b for *_, b in own})).where(here), self.keys, order)

    def append(self, df: DataFrame, batch: str, order: list[str] | None = None) -> DataFrame:
        """Add what the store lacks of ``df`` as ``batch``, and return those rows. A batch that is there already is left
        alone; one that failed before its manifest was written is written anew."""
        batch_name(batch)
        folder, said = f"{self.path}/batch={batch}", f"{self.path}/manifest/batch={batch}"
        if batch in self.batches():
            return self._of([batch])
        own = df.select(*(F.col(c) for c in self.schema.names if c != "block_bucket"), F.floor(F.col("block_number") / self.width).cast("long").alias("block_bucket"))
        new = self.lacking(own, order)
        dealt = new.repartition(*PARTITION).sortWithinPartitions(*PARTITION, *(k for k in self.keys if k not in PARTITION))
        # tasks move their own files into place, not the driver all of them: nobody sees these before the manifest
        dealt.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*PARTITION).parquet(folder)
        self._listed.pop((batch,), None)  # of an attempt whose manifest failed
        written = self._of([batch])
        sums = written.groupBy(*PARTITION).agg(F.count("*").alias("n_rows"))
        # one task, a row for each partition; Spark's committer moves its file into place as the last step
        sums.select(*(F.col(c).cast("long") for c in ("chain_id", "block_bucket", "n_rows"))).coalesce(1).write.mode("overwrite").parquet(said)
        return written
