"""Event-time queries as Structured Streaming.

Each query reads the events as a file stream, works under a watermark, so its
state is bounded by the events of the watermark's span, and writes each
micro-batch to the shared folder; ``availableNow`` drains what is there.  A
result is read from all batches: of a window's counts the latest, of pairs each
once, however the input falls into batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.plans.staging import shared_dir


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    schema = spark.read.parquet(path).schema  # a glob, as the file source takes single files only by glob
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def drain(stream: DataFrame, mode: str) -> DataFrame:
    """Runs a stream to the end of its input; its rows with their ``batch``."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        # a batch that is run again after a failure replaces what it wrote
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{base}/out")


def hourly_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Events per hour and type; what comes later than the watermark is dropped,
    and hours before it leave the state."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    rows = drain(counted, "update")
    latest = rows.groupBy("w", "event_type").agg(F.max_by("n", "batch").alias("n"))
    return latest.select(F.floor(F.unix_seconds("w.start") / 3600).cast("long").alias("hour"), "event_type", "n")


def distinct_pairs(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Distinct (user, type) pairs.  The stream holds back what it has passed on
    within the watermark's span; a pair that returns after it comes again, and is
    made one with the earlier when the result is read."""
    kept = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["user_id", "event_type"]).select("user_id", "event_type")
    return drain(kept, "append").select("user_id", "event_type").distinct()


def stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_counts(event_stream(spark, f"{sf_dir}/events.parque[t]"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_pairs(event_stream(spark, f"{sf_dir}/events.parque[t]"))
