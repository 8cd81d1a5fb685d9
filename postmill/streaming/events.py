"""Streams: daily windows, sessions and duplicates with watermarks, and upserts by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from postmill.sources.store import upsert

LATE = "1 day"


def read_stream(spark: SparkSession, folder: str, name: str, stamp: str = "ts") -> DataFrame:
    """A stream of the Parquet files of one table, which is a file or a folder; the event time becomes a timestamp."""
    now = spark.read.parquet(f"{folder}/{name}")
    single = now.inputFiles()[0].rstrip("/").endswith(f"/{name}")
    reader = spark.readStream.schema(now.schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(f"{folder}/{name}")
    return stream.withColumn(stamp, F.col(stamp).cast("timestamp"))


def daily(events: DataFrame, stamp: str = "ts") -> DataFrame:
    """Events, people and sum of values by day and type; a day is final once the watermark has passed it."""
    return (
        events.withWatermark(stamp, LATE)
        .groupBy(F.window(stamp, "1 day").alias("w"), "event_type")
        .agg(F.count("*").alias("events"), F.approx_count_distinct("user_id", 0.01).alias("people"), F.sum("value").alias("total"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "events", "people", "total")
    )


def sessions(events: DataFrame, gap: str = "6 hours", stamp: str = "ts") -> DataFrame:
    """Runs of a person's events with no longer pause than the gap."""
    grouped = events.withWatermark(stamp, LATE).groupBy(F.session_window(stamp, gap).alias("w"), "user_id").agg(F.count("*").alias("events"))
    return grouped.select("user_id", F.col("w.start").alias("first_at"), F.col("w.end").alias("until"), "events")


def once(events: DataFrame, key: str = "event_id", stamp: str = "ts") -> DataFrame:
    """Each key once, as far back as the watermark."""
    return events.withWatermark(stamp, LATE).dropDuplicatesWithinWatermark([key])


#: Keys of a bucket: a batch rewrites the buckets of its keys and no others.
BUCKET = 1_000


def newest(table: DataFrame, before: int | None = None) -> DataFrame:
    """The rows of the newest version of each bucket, of those before a version if one is given."""
    versions = table if before is None else table.where(F.col("version") < before)
    last = versions.groupBy("bucket").agg(F.max("version").alias("version"))
    return versions.join(last, ["bucket", "version"], "left_semi")


def upsert_into(events: DataFrame, path: str, checkpoint: str, key: str = "event_id", stamp: str = "ts", width: int = BUCKET) -> StreamingQuery:
    """Merge each micro-batch into a table in buckets of neighbouring keys, so that a batch rewrites only what it touches.

    A batch reads the newest versions of its own buckets and writes these under its number; other buckets stay as they
    are. A batch that runs again reads older versions only and overwrites its own, so it gives the same. `newest` reads
    the table.

    A file holds a range of buckets in their order: files are as many as the rows ask for, not one for each bucket and
    task, and Parquet's statistics keep a batch from what lies outside its range.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark, batch = batch.sparkSession, batch.withColumn("bucket", F.floor(F.col(key) / width))
        if number:
            schema = StructType([*batch.schema.fields, StructField("version", IntegerType())])
            first, last = batch.agg(F.min("bucket"), F.max("bucket")).first()
            near = spark.read.schema(schema).parquet(path).where(F.col("bucket").between(first, last))
            held = newest(near, number).join(batch.select("bucket").distinct(), "bucket", "left_semi")
            merged = upsert(held.select(*batch.columns), batch, key, stamp, "bucket")
        else:
            merged = upsert(batch.limit(0), batch, key, stamp, "bucket")
        merged.write.mode("overwrite").parquet(f"{path}/version={number}")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there and read its finished rows."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
