"""Extension: the idle timeout of word lookups as sessions over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, gap: str = "6 hours", late: str | None = None, by: str = "user_id", ts: str = "ts") -> DataFrame:
    """(by, start, end, n) of runs of events less than gap apart; a stream needs late, the watermark's delay."""
    df = events.withWatermark(ts, late) if late else events
    s = F.session_window(ts, gap)
    return df.groupBy(by, s.alias("s")).agg(F.count("*").alias("n")).select(by, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")
