"""Incremental runs: new files only, by Structured Streaming with a checkpoint, and late repeats by watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_text_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """A stream of files below the root: ``path`` and ``text``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    raw = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return raw.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def run_available(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Give what is new since the last run to ``batch``, then end: a scheduled run that skips what it has seen."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
    query.awaitTermination()
    return query


def distinct_within(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of keys that come within the delay; the state is bounded by the watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def event_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "events.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
