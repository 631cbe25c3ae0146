"""Filter and exact duplicate removal over unbounded input; near duplicates need the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FilterConfig
from ..functions.text import prefix_key, squeeze
from ..operators.quality import text_reason


def filter_stream(stream: DataFrame, config: FilterConfig = FilterConfig(), caption: str = "caption") -> DataFrame:
    """The stream with `reason`; stateless."""
    return stream.withColumn("reason", text_reason(squeeze(F.col(caption)), config))


def first_of_keys(stream: DataFrame, event_time: str, lateness: str, caption: str = "caption", key: str | None = None) -> DataFrame:
    """One row for each key within the watermark: later copies fall, and state older than the watermark is dropped."""
    prefix = prefix_key(F.coalesce(F.col(caption), F.lit("")))
    keyed = stream.withColumn("_key", F.coalesce(F.col(key), prefix) if key else prefix)
    return keyed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def reason_windows(stream: DataFrame, event_time: str, lateness: str, window: str = "1 hour") -> DataFrame:
    """Counts of reasons in tumbling windows of event time."""
    return stream.withWatermark(event_time, lateness).groupBy(F.window(event_time, window), "reason").agg(F.count(F.lit(1)).alias("n"))
