"""The pool as a stream: first arrivals by id within a horizon, and arrivals per day, on event time with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType()),
                       T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def events(spark: SparkSession, path: str, files_a_batch: int = 64) -> DataFrame:
    """Parquet files of events as they arrive."""
    schema = T.StructType([f if f.name != "ts" else T.StructField("ts", T.TimestampNTZType()) for f in SCHEMA.fields])
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def first_seen(stream: DataFrame, keys: list[str], horizon: str = "14 days") -> DataFrame:
    """The first event of each key within the horizon; state older than it is dropped."""
    return stream.withWatermark("ts", horizon).dropDuplicatesWithinWatermark(keys)


def per_day(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """Events and distinct users (approximate in a stream) per day and type; days are final once the watermark passes them."""
    return (
        stream.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "event_type")
        .agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("value"))
        .select(F.to_date("window.start").alias("day"), "event_type", "n", "users", "value")
    )


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Runs the stream over all that is there and stops."""
    q = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    q.awaitTermination()
    return q
