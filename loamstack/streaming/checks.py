"""Checks on streams: the quality rules are stateless, duplicates need a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loamstack.operators import quality


def read_records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A folder into which JSON lines are dropped."""
    return spark.readStream.schema(schema).json(folder)


def passing(stream: DataFrame, event_time: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Records without errors, once each (by image, question and answer) within the watermark."""
    good = quality.passing(stream)
    keys = [c for c in ("image", "question", "answer") if c in good.columns]
    return good.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys) if event_time else good


def write(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything that is there now, exactly once."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
