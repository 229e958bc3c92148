"""Streaming forms: deliveries kept once, and trailing totals, with a watermark that bounds the state.

What arrives later than the watermark allows is what batch reconciliation
(``operators.deliveries``) is for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.operators.deliveries import numeric_identity


def stream_events(spark, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the JSON-lines files that land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def once_per_id(messages: DataFrame, ts: str, event_id: str, lateness: str = "7 days") -> DataFrame:
    """The first copy to arrive of each identifier within the lateness; messages without one pass unchanged and take up no state."""
    keyed = messages.withWatermark(ts, lateness).withColumn("_key", numeric_identity(F.col(event_id)))
    once = keyed.where("_key IS NOT NULL").dropDuplicatesWithinWatermark(["_key"])
    return once.unionByName(keyed.where("_key IS NULL")).drop("_key")


def pair_totals(events: DataFrame, ts: str, days: int = 7, lateness: str = "2 days") -> DataFrame:
    """Summed weight per country pair over sliding windows of ``days`` that move by a day."""
    pairs = events.withWatermark(ts, lateness).select(ts, "weight", F.explode("country_pairs").alias("p")).where("size(p) = 2 AND p[0] <> p[1]")
    window = F.window(ts, f"{days} days", "1 day").alias("w")
    return pairs.groupBy(window, F.least(F.col("p")[0], F.col("p")[1]).alias("source"), F.greatest(F.col("p")[0], F.col("p")[1]).alias("target")).agg(F.sum("weight").alias("weight")).select("w.start", "w.end", "source", "target", "weight")
