"""The batch counts of the events table kept up to date on a stream. Beyond the record operators; for arriving exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, pattern: str = "events.parquet") -> DataFrame:
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events and their value by type and window; rows later than ``late`` behind the newest are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")


def first_seen(events: DataFrame, key: str, late: str = "2 days") -> DataFrame:
    """Each key once within the time that late rows are waited for."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def run_once(result: DataFrame, path: str, checkpoint: str) -> None:
    """Everything that has arrived, appended to Parquet exactly once."""
    result.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start().awaitTermination()
