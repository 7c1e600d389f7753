"""Event streams: windows with watermarks, first-wins dedupe, sessions, and keyed state between micro-batches.

Each function takes a streaming DataFrame (or a plain one, with the same rows as
result) with an event time; late rows beyond the watermark are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, files_a_trigger: int = 1) -> DataFrame:
    """A folder of Parquet event files as a stream, the time read as a timestamp."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """Count, sum and the greatest value by window and type; ``slide`` makes windows overlap."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    g = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type")
    return g.agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max("value").alias("most")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total", "most")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user: events with no gap as long as ``gap`` between them."""
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return g.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def first_by_key(events: DataFrame, keys: list[str], late: str = "2 hours") -> DataFrame:
    """One event a key while the watermark remembers it."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def joined_within(left: DataFrame, right: DataFrame, seconds: int = 3600, late: str = "2 hours") -> DataFrame:
    """Pairs of one user with the right event at most ``seconds`` after the left one: state is bounded by the watermark."""
    a = left.withWatermark("ts", late).select("user_id", F.col("event_id").alias("left_id"), F.col("ts").alias("left_ts"))
    b = right.withWatermark("ts", late).select(F.col("user_id").alias("r_user"), F.col("event_id").alias("right_id"), F.col("ts").alias("right_ts"))
    within = (F.col("right_ts") >= F.col("left_ts")) & (F.col("right_ts") <= F.col("left_ts") + F.expr(f"interval {seconds} seconds"))
    return a.join(b, (F.col("user_id") == F.col("r_user")) & within).drop("r_user")


def keep_state(events: DataFrame, path: str, update, checkpoint: str):
    """Folds each micro-batch into a state table at ``path``: state' = update(state or None, batch).

    Each batch writes its own version folder; one that is written again after a
    failure gives the same folder, so every batch counts once.
    """
    spark = events.sparkSession

    def fold(batch: DataFrame, number: int) -> None:
        before = spark.read.parquet(f"{path}/v={number - 1}") if number else None
        update(before, batch).write.mode("overwrite").parquet(f"{path}/v={number}")

    return events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_user(before: DataFrame | None, batch: DataFrame) -> DataFrame:
    """A state of first and last time and count of each user."""
    now = batch.groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count("*").alias("n"))
    both = now if before is None else before.unionByName(now)
    return both.groupBy("user_id").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("n").alias("n"))
