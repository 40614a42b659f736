"""Daily roll-ups and ingest as Structured Streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_rollup(stream: DataFrame, keys: list[str], value: str, time: str = "time", late: str = "2 days", offset: str = "0 hours") -> DataFrame:
    """Sum, mean, least and greatest value per day; rows later than ``late`` are dropped by the watermark."""
    stamped = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    day = F.window(time, "1 day", "1 day", offset)
    return stamped.groupBy(*keys, day.alias("w")).agg(F.sum(value).alias("total"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("greatest")).select(*keys, F.col("w.start").alias(time), "total", "mean", "least", "greatest")


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, files_per_batch: int = 360) -> StreamingQuery:
    """Appends the Parquet files that the source folder has gained, once, in batches."""
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return files.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
