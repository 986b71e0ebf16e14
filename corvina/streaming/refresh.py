"""Incremental refresh with Structured Streaming.

New files become rows once: a stream over a folder keeps what it has read in its checkpoint,
drops content it has seen, and stops when all that is there is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_rows(spark: SparkSession, folder: str, schema: T.StructType | str, *, per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet rows that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def once_by_content(stream: DataFrame, content: str, *, at: str | None = None, late: str = "30 days") -> DataFrame:
    """The first row with each content. With an event time, contents older than ``late`` are forgotten, so the state stays bounded."""
    keyed = stream.withColumn("content_md5", F.md5(F.col(content).cast("binary")))
    if at is None:
        return keyed.dropDuplicates(["content_md5"])
    # A watermark needs an instant, which a time without a zone isn't.
    return keyed.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark(["content_md5"])


def window_counts(stream: DataFrame, at: str, width: str, *keys: str, late: str = "1 day") -> DataFrame:
    """Rows per time window and key; a window is final once it is ``late`` behind."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def refresh(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append all that is new to a Parquet folder and stop; a repeated call appends what came since."""
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def unprocessed(found: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The found rows whose key isn't among the done ones: resuming a batch."""
    return found.join(done.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")
