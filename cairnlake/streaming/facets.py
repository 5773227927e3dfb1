"""Facet counts over a stream of edges or events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, time: str, facet: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, end, facet, n): events per window and value; events later than `late` behind the newest are dropped."""
    timed = events.withColumn("__ts", F.col(time).cast("timestamp")).withWatermark("__ts", late)
    counted = timed.groupBy(F.window("__ts", width).alias("w"), facet).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), facet, "n")


def first_seen(events: DataFrame, time: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """The first event of each key within the watermark, so that an edge that is sent again is counted once."""
    timed = events.withColumn("__ts", F.col(time).cast("timestamp")).withWatermark("__ts", late)
    return timed.dropDuplicatesWithinWatermark(keys).drop("__ts")
