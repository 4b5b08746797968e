"""Structured Streaming forms of the incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from meterline.functions.scalars import DAY_MS


def deduplicated(stream: DataFrame, delay: str = "24 hours") -> DataFrame:
    """One row of each event_hash; a copy may come as late as the delay after the first. State older than that is dropped."""
    timed = stream.withColumn("event_time", F.timestamp_millis("timestamp_ms"))
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_hash"])


def daily(stream: DataFrame, delay: str = "24 hours") -> DataFrame:
    """Cost and events by key and UTC day, given out when the day can't change any more."""
    day = F.window("event_time", "1 day")
    sums = deduplicated(stream, delay).groupBy(day.alias("_day"), "key_id").agg(F.count("*").alias("requests"), F.sum("cost_micros").alias("cost_micros"))
    return sums.select("key_id", F.floor(F.unix_millis("_day.start") / DAY_MS).cast("long").alias("day_bucket"), "requests", "cost_micros")


def load_new(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends events that the Parquet table at target lacks, batch by batch, under the batch's number.

    A batch that is run again replaces its own partition and looks at earlier ones alone, so nothing is lost or doubled.
    """
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])

    def batch(rows: DataFrame, number: int) -> None:
        new = rows.dropDuplicates(["event_hash"])
        if number > 0:
            held = rows.sparkSession.read.schema(schema).parquet(target).where(F.col("batch") < number)
            new = new.join(held.select("event_hash"), "event_hash", "left_anti")
        new = new.select(*rows.columns, F.lit(number).cast("long").alias("batch"))
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
