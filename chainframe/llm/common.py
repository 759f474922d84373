"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the operators' word and line rules have it.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Characters that a task holds decoded at a time; a longer text is a chunk of its own.
CHUNK_CHARS = 1_000_000


_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Without it, in local mode, a temporary one for
    each application; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="spark-chainframe-")
    return _local[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, not a recomputation, and gives later plans real sizes.
    The tables of one application lie in one folder, named after its id, which may be removed when it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/chainframe-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with at most ``most`` characters each, or a single text."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
