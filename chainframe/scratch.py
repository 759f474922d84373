"""Tables between steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Without it, in local mode, a temporary one for
    each application; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = "file://" + tempfile.mkdtemp(prefix="spark-chainframe-")
        folder = _local[app]
    return f"{folder.rstrip('/')}/chainframe-scratch"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to a table and read back: worked out once however often it is used, its size known, and a lost
    executor costs a re-read."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
