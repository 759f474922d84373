"""A streaming source over a store of batches whose offset is the last block of each chain.

Nothing rests on files' names or times: a batch is the blocks after one offset up to the next, each chain on its own, read
from the partitions of the store that hold them. The driver reads manifests and the footers of a chain's top partition.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from chainframe.sources.blocks import BUCKET


class Piece(InputPartition):
    """Blocks after ``lo`` and up to ``hi`` of one partition of the store."""

    def __init__(self, chain: int, bucket: int, lo: int, hi: int, batches: list[str]):
        super().__init__((chain, bucket, lo, hi))
        self.chain, self.bucket, self.lo, self.hi, self.batches = chain, bucket, lo, hi, batches


class BlockStream(DataSource):
    """Options: path; width, of a block bucket; after, a chain's last block that isn't wanted, by chain, as JSON; end, the
    last block wanted of any chain."""

    @classmethod
    def name(cls) -> str:
        return "block_store"

    def schema(self) -> StructType:
        raise ValueError("block_store needs a schema")

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return BlockReader(dict(self.options), schema)


class BlockReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.columns = options["path"].rstrip("/"), schema
        self.width, self.end = int(options.get("width", BUCKET)), int(options["end"]) if "end" in options else None
        self.after = {int(c): int(n) for c, n in json.loads(options.get("after", "{}")).items()}
        self.manifests: dict[str, list[tuple[int, int]]] = {}  # batch -> its partitions; a batch's manifest never changes

    def __getstate__(self) -> dict:
        return {**self.__dict__, "manifests": {}}  # tasks need none

    def files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path.replace("s3a://", "s3://", 1))

    def holders(self) -> dict[int, dict[int, list[str]]]:
        """chain -> bucket -> batches with rows there."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, root = self.files()
        for folder in system.get_file_info(fs.FileSelector(f"{root}/manifest", allow_not_found=True)):
            batch = folder.base_name.removeprefix("batch=")
            if folder.base_name.startswith("batch=") and batch not in self.manifests:
                parts = [f.path for f in system.get_file_info(fs.FileSelector(folder.path)) if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
                if parts:  # without one the batch isn't committed yet
                    rows = [r for p in parts for r in pq.read_table(p, filesystem=system, partitioning=None).to_pylist()]
                    self.manifests[batch] = [(r["chain_id"], r["block_bucket"]) for r in rows]
        out: dict[int, dict[int, list[str]]] = {}
        for batch in sorted(self.manifests):
            for chain, bucket in self.manifests[batch]:
                out.setdefault(chain, {}).setdefault(bucket, []).append(batch)
        return out

    def datasets(self, chain: int, bucket: int, batches: list[str], columns=None):
        import pyarrow.dataset as ds

        system, root = self.files()
        for b in batches:
            yield ds.dataset(f"{root}/batch={b}/chain_id={chain}/block_bucket={bucket}", schema=columns, format="parquet", filesystem=system)

    def top(self, chain: int, buckets: dict[int, list[str]]) -> int:
        """The chain's greatest block that is wanted, by the statistics of its files."""
        import pyarrow.compute as pc

        for bucket in sorted(buckets, reverse=True):
            if self.end is not None and bucket * self.width > self.end:
                continue
            if self.end is not None and (bucket + 1) * self.width > self.end + 1:  # ends within the bucket: look at its blocks
                own = [pc.max(d.to_table(columns=["block_number"], filter=pc.field("block_number") <= self.end)["block_number"]).as_py() for d in self.datasets(chain, bucket, buckets[bucket])]
            else:
                groups = [g for d in self.datasets(chain, bucket, buckets[bucket]) for f in d.get_fragments() for g in f.row_groups if g.num_rows]
                own = [g.statistics["block_number"]["max"] for g in groups]
            own = [n for n in own if n is not None]
            if own:
                return max(own)
        return -1

    def initialOffset(self) -> dict:
        return {str(c): n for c, n in sorted(self.after.items())}

    def latestOffset(self) -> dict:
        tops = {c: self.top(c, buckets) for c, buckets in self.holders().items()}
        every = {c: max(tops.get(c, -1), self.after.get(c, -1)) for c in tops.keys() | self.after.keys()}
        return {str(c): n for c, n in sorted(every.items()) if n >= 0 or c in self.after}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        back = [c for c in start if end.get(c, -2) < start[c]]
        if back:
            raise ValueError(f"the store, or the end that is asked for, lies before what chains {', '.join(back)} have delivered")
        held, out = self.holders(), []
        for c in end:
            lo, hi = start.get(c, -1), end[c]
            wanted = {b: batches for b, batches in held.get(int(c), {}).items() if (lo + 1) // self.width <= b <= hi // self.width}
            out += [Piece(int(c), b, lo, hi, batches) for b, batches in sorted(wanted.items()) if hi > lo]
        return out

    def read(self, partition: Piece) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark.sql.pandas.types import to_arrow_schema

        whole = to_arrow_schema(self.columns)
        known = {"chain_id": partition.chain, "block_bucket": partition.bucket}
        stored = pa.schema([f for f in whole if f.name not in known])
        if "block_number" not in stored.names:
            stored = stored.append(pa.field("block_number", pa.int64()))
        number = pc.field("block_number")
        for d in self.datasets(partition.chain, partition.bucket, partition.batches, stored):
            for batch in d.to_batches(columns=[n for n in whole.names if n not in known], filter=(number > partition.lo) & (number <= partition.hi)):
                if batch.num_rows:
                    columns = [pa.array([known[f.name]] * batch.num_rows, f.type) if f.name in known else batch.column(f.name) for f in whole]
                    yield pa.RecordBatch.from_arrays(columns, schema=whole)


def stream_store(spark: SparkSession, path: str, schema, after: dict[int, int] | None = None, end: int | None = None, width: int = BUCKET) -> DataFrame:
    """Streaming rows of the manifest.Store at ``path``: of each chain the blocks after those delivered, or after ``after``
    (chain -> block) where a query begins, up to ``end``.

    A query resumes by its checkpoint at each chain's last block, whatever files the store has gained since. A chain's blocks
    are to be committed in order, whole blocks at a time: what a later batch adds at or below a chain's offset isn't
    delivered. An offset never goes back: that is an error. A trigger takes all blocks there are, in a task for each
    partition of the store, so a batch of any size has tasks of bounded size, and chains are read side by side. Rows of a
    block keep their order within a task. An empty store, or one without a batch yet, gives no rows.
    """
    spark.dataSource.register(BlockStream)
    reader = spark.readStream.format("block_store").schema(schema).option("path", path).option("width", width)
    reader = reader.option("after", json.dumps(after or {}))
    return (reader if end is None else reader.option("end", end)).load()
