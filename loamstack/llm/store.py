"""Tables that the stages of one operator hand to each other, in storage that every executor sees."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; in a plain local session without one, a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file:///tmp/checkpoints/loamstack"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's own limit is 100 000; several keys share a bucket beyond this number.
MOST_BUCKETS = 10_000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB, so that a worker's memory does not follow the length of the texts. A smaller limit stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).rstrip("b"))
    if not 0 < now <= 4 << 20:
        spark.conf.set(key, str(4 << 20))


def bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``df`` as a table bucketed by ``key`` in the warehouse: passes that group by the key need no shuffle of it."""
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("compression", "zstd").format("parquet").saveAsTable(table)
    return df.sparkSession.read.table(table)


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it again: this cuts the lineage and outlives a lost executor."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
