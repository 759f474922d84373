"""Filling a store from a larger one, range by range: what was read once isn't read again.

Beside the store lie the ranges that each batch was to read and those that it has read. A batch first writes its plan, then
its rows, then its coverage. One that failed halfway runs again by its own plan, so that its rows and its coverage agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainframe.operators.windows import coalesce_intervals, missing_ranges
from chainframe.sources.blocks import scan_windows
from chainframe.sources.manifest import Store, batch_name

RANGES = "chain_id bigint, lo bigint, hi bigint"


class Backfill:
    """Fills ``into`` with those rows of ``source`` that ``select`` takes. Both are stores; ``spec`` names what ``select``
    takes, and coverage counts for the same spec only. Several specs may fill one store: rows count once."""

    def __init__(self, into: Store, source: Store, spec: str, select: Callable[[DataFrame], DataFrame]):
        self.into, self.source, self.spec, self.select = into, source, spec, select
        self.spark, self.folder = into.spark, f"{into.path}-ranges/{spec}"

    def covered(self) -> DataFrame:
        """(chain_id, lo, hi), half-open and merged, that batches of this spec have read."""
        try:
            found = self.spark.read.schema(RANGES).parquet(f"{self.folder}/covered")
        except Exception as error:  # before the first batch
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], RANGES)
        return coalesce_intervals(found.withColumnRenamed("chain_id", "fragment_id")).withColumnRenamed("fragment_id", "chain_id").select("chain_id", "lo", "hi")

    def missing(self, wanted: DataFrame) -> DataFrame:
        """(chain_id, lo, hi) of ``wanted`` (chain_id, want_lo, want_hi; one row a chain) that no batch has read."""
        named = [df.withColumnRenamed("chain_id", "fragment_id") for df in (self.covered(), wanted)]
        return missing_ranges(*named).select(F.col("fragment_id").cast("long").alias("chain_id"), F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))

    def rows(self, ranges: DataFrame) -> DataFrame:
        """Rows of the source in ``ranges``. Its partitions elsewhere aren't read, and ranges meet rows bucket by bucket."""
        width = self.source.width
        found = scan_windows(self.source.read(), ranges.select("chain_id", "lo", (F.col("hi") - 1).alias("hi")), self.source.partitions(), width)
        buckets = F.explode(F.sequence(F.floor(F.col("lo") / width).cast("long"), F.floor((F.col("hi") - 1) / width).cast("long")))
        cut = ranges.select(F.col("chain_id").alias("r_chain"), F.col("lo").alias("r_lo"), F.col("hi").alias("r_hi"), buckets.alias("r_bucket"))
        inside = (F.col("chain_id") == F.col("r_chain")) & (F.col("block_bucket") == F.col("r_bucket")) & (F.col("block_number") >= F.col("r_lo")) & (F.col("block_number") < F.col("r_hi"))
        return found.join(cut, inside, "left_semi")

    def fill(self, wanted: DataFrame, batch: str) -> DataFrame:
        """Read what is missing of ``wanted`` and add it to the store as ``batch``; gives the rows that it added, or had
        added before. A source that ends before a range counts as read: hold ``wanted`` to what the source has in full, such
        as finalised blocks. No row for a chain wants nothing of it."""
        name = batch_name(f"{self.spec}-{batch}")
        planned = f"{self.folder}/planned/batch={batch}"
        if name not in self.into.batches():  # else its rows are those of the plan that is there
            self.missing(wanted).write.mode("overwrite").parquet(planned)
        plan = self.spark.read.schema(RANGES).parquet(planned)
        added = self.into.append(self.select(self.rows(plan)), name)
        plan.write.mode("overwrite").parquet(f"{self.folder}/covered/batch={batch}")
        return added
