"""Exact dedup against a persistent digest index, with DataFrame functions only.

The index is bucketed and sorted by the digest, so joins with it need no shuffle of its side, nor a sort of its base. A batch of
documents is reduced to one row per digest (pre-aggregated before its shuffle, so groups of copies cost one row a task),
goes through a sort-merge anti-join with the index, and what is new is appended. Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.llm.common import ASCII_SPACE, materialize, shared_folder, text_of


def normalized(text: Column) -> Column:
    """The text without ASCII white space."""
    for c in ASCII_SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def digests(df: DataFrame) -> DataFrame:
    """(doc_id, row, n_chars, digest) per row; ``row`` tells repeated rows apart. Materialise it before using row."""
    text = text_of("text")
    digest = F.unhex(F.sha2(normalized(text).cast("binary"), 256))
    return df.select("doc_id", F.monotonically_increasing_id().alias("row"), F.char_length(text).alias("n_chars"), digest.alias("digest"))


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: which row stays (most code points, then smallest doc_id, null last, then first row), group size."""
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row")
    best = rows.groupBy("digest").agg(F.min_by(F.struct("doc_id", "row"), order).alias("best"), F.count("*").alias("group_size"))
    return best.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")


@contextmanager
def ordered_scans(spark: SparkSession) -> Iterator[None]:
    """Plans made inside rely on the order of buckets that are one file each, so that joins don't sort these again."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class DigestIndex:
    """The index (digest, keep_id, batch) as tables of the session's catalog beside ``path``, bucketed and sorted by digest:
    a base with one sorted file a bucket, which joins take as it is, and what was appended since.

    When appended batches have ``every`` files a bucket, both are written as the base of the next generation, so a bucket
    has ``every`` files and one at most; a generation counts when its row is written, and one that failed is written anew.
    Tables of earlier generations may be removed when nothing reads them.

    Opening an existing path continues it, under any table name. Digests carry the batch that brought them: a batch that
    runs again, because it failed after its append or in the midst of it, finds its own digests new, and appends only those
    that are lacking. Two writers at a time are not supported.
    """

    spark: SparkSession
    table: str
    path: str
    buckets: int = 64
    every: int = 8

    def __post_init__(self) -> None:
        self.generation = 0
        self._open()

    def _open(self) -> None:
        try:
            rows = self.spark.read.schema("generation INT").parquet(f"{self.path}-generations")
            self.generation = rows.agg(F.max("generation")).first()[0] or 0
        except Exception as error:  # no base yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
        g = self.generation
        self.recent, self.base = (f"{self.table}_recent_{g}", f"{self.table}_base_{g}") if g else (self.table, None)
        for name, path in ((self.recent, f"{self.path}-recent-{g}" if g else self.path), (self.base, f"{self.path}-base-{g}")):
            if name:
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                    f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
                )

    def parts(self) -> list[DataFrame]:
        """The index's tables as they are now: files are listed anew, as another session may have appended some."""
        self._open()
        names = [n for n in (self.base, self.recent) if n]
        for n in names:
            self.spark.catalog.refreshTable(n)
        return [self.spark.table(n) for n in names]

    def known(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.parts())

    def unseen(self, found: DataFrame, batch: str) -> DataFrame:
        """Rows of ``found`` (unique by digest) whose digest no other batch brought, with ``stored``: ``batch`` did before."""
        out, own = found, []
        for part in self.parts():
            out = out.join(part.where(F.col("batch") != batch).select("digest").hint("merge"), "digest", "left_anti")
            own.append(part.where(F.col("batch") == batch).select("digest"))
        own = reduce(DataFrame.unionByName, own).withColumn("stored", F.lit(True)).hint("merge")
        return out.join(own, "digest", "left").withColumn("stored", F.coalesce("stored", F.lit(False)))

    def append(self, found: DataFrame, batch: str) -> DataFrame:
        """Add what is new and return it, with what ``batch`` has added before."""
        with ordered_scans(self.spark):
            new = materialize(self.unseen(found, batch))
        added = new.where("NOT stored").select("digest", F.col("keep_id").cast("long"), F.lit(batch).alias("batch"))
        self._write(added, "append", self.recent, f"{self.path}-recent-{self.generation}" if self.generation else self.path)
        return new

    def recorded(self, found: DataFrame) -> DataFrame:
        """Rows of ``found`` whose digest the index has, with its keep_id as known_id."""
        parts = [found.join(p.select("digest", F.col("keep_id").alias("known_id")).hint("merge"), "digest") for p in self.parts()]
        return reduce(DataFrame.unionByName, parts)

    def compact(self) -> None:
        """Begin the next generation if buckets have gained ``every`` files."""
        whole = self.known()
        if len(self.spark.table(self.recent).inputFiles()) < self.every * self.buckets:
            return
        g = self.generation + 1
        self._write(whole, "overwrite", f"{self.table}_base_{g}", f"{self.path}-base-{g}")
        self.spark.range(1).select(F.lit(g).alias("generation")).write.mode("append").parquet(f"{self.path}-generations")
        self._open()

    def _write(self, rows: DataFrame, mode: str, table: str, path: str) -> None:
        (
            rows.repartition(F.pmod(F.hash("digest"), F.lit(self.buckets)))  # a bucket's rows in one task: one file each
            .write.mode(mode).format("parquet")
            .bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", path).saveAsTable(table)
        )


def dedup(df: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """Every row of ``df`` (doc_id, text; other columns are ignored): doc_id, keep_id, group_size, kept, text_sha256.

    ``batch`` names these rows: running it again, with the same rows, gives the same result, however far the first run
    came. Texts are equal when the same without ASCII white space; null is empty; texts of any length are hashed whole. Of a group new to the index the row with the
    most code points stays, then the smallest doc_id (null last), then the first of repeated rows; exactly one row of it
    is kept. A group that the index knows keeps none, and keep_id is the one recorded. group_size counts the rows of
    this batch. An empty table gives no rows.

    Groups' results go back to the rows by an equi-join whose sides are both plain tables: large groups of copies are
    split by adaptive skew-join handling.
    """
    rows = materialize(digests(df))
    found = materialize(winners(rows))
    fresh = index.append(found, batch)
    old = index.recorded(found).join(fresh.select("digest"), "digest", "left_anti")
    with ordered_scans(df.sparkSession):
        groups = materialize(
            fresh.select("digest", "keep_id", "keep_row", "group_size").unionByName(
                old.select("digest", F.col("known_id").alias("keep_id"), F.lit(-1).cast("long").alias("keep_row"), "group_size")
            )
        )
    index.compact()
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder."""
    import uuid

    name = f"digest_index_{uuid.uuid4().hex}"
    return DigestIndex(spark, name, f"{shared_folder(spark)}/{name}")


ORACLE_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents),
best AS (
  SELECT text_sha256, count(*) AS group_size, (array_agg(doc_id ORDER BY n DESC, doc_id))[1] AS keep_id
  FROM rows GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM rows JOIN best USING (text_sha256)
"""
