"""Duplicates of a stream against everything that was ever seen, however long ago, with an index that batches share.

The index is a folder of keys (MD5 of the columns that make a record), a subfolder for each micro-batch. A micro-batch keeps
its first row of each key, drops keys that earlier batches hold, and writes its rows, then its keys, both over whatever a
failed try of the same batch has left: a batch that runs again gives the same rows once. A batch of its own (a table) can
be put into the index before the stream starts. Keys cost 16 bytes each; a batch reads those of the index once, so ``compact``
should run now and then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamstack.operators.split import dedup_first

_KEYS = "key binary, batch string"


class SeenIndex:
    """Keys of ``columns`` in ``path``, which need not exist yet. Null counts as a value of its own."""

    def __init__(self, spark: SparkSession, path: str, columns: list[str]):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), columns

    def key(self) -> Column:
        parts = [F.coalesce(F.concat(F.lit("+"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in self.columns]
        return F.unhex(F.md5(F.concat(*parts).cast("binary")))

    def _there(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def keys(self) -> DataFrame:
        """key, batch (the name of the batch that brought it)."""
        return self.spark.read.schema(_KEYS).parquet(self.path) if self._there(self.path) else self.spark.createDataFrame([], _KEYS)

    def add(self, batch: DataFrame, name: str, out: str | None = None) -> None:
        """Put the new rows of ``batch`` (first of each key in the order of all columns) into ``out``/batch=name, and their keys into the index."""
        keyed = batch.withColumn("_key", self.key())
        first = dedup_first(keyed, ["_key"], [c for c in batch.columns if dict(batch.dtypes)[c] not in ("map", "variant")])
        known = self.keys().filter(F.col("batch") != name).select(F.col("key").alias("_key"))
        new = first.join(known, "_key", "left_anti")
        if out is not None:
            new.select(*batch.columns).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={name}")
        # Last: a batch whose keys are here has its rows in place.
        new.select(F.col("_key").alias("key")).write.mode("overwrite").parquet(f"{self.path}/batch={name}")

    def stream(self, stream: DataFrame, out: str, checkpoint: str, name: str = "s") -> StreamingQuery:
        """Everything that is there now; ``name`` tells the batches of several streams apart."""
        session = lambda df, i: self.add(df, f"{name}{i}", out)
        return stream.writeStream.foreachBatch(session).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def compact(self, path: str, files: int = 16) -> SeenIndex:
        """A new index in ``path`` with the same keys in a few files, as one batch."""
        self.keys().select("key").distinct().repartition(files, "key").write.parquet(f"{path.rstrip('/')}/batch=all")
        return SeenIndex(self.spark, path, self.columns)
