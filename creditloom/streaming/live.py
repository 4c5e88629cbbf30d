"""Event-time monitors on streams: decision-rate breakers and account activity.

The same functions run on a batch frame, which is how they are tested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.drift import breakers, operational_metrics


def _marked(df: DataFrame, time: str, late: str | None) -> DataFrame:
    return df.withWatermark(time, late) if late and df.isStreaming else df


def rolling_breakers(scored: DataFrame, time: str = "scored_at", width: str = "1 day", slide: str | None = None,
                     late: str | None = "1 hour") -> DataFrame:
    """Operational breakers per event-time window: (window_start, window_end, metric, value, level, note)."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    m = operational_metrics(_marked(scored, time, late), [w.alias("w")])
    m = m.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}).drop("w")
    return breakers(m, ["window_start", "window_end"])


def nsf_windows(events: DataFrame, time: str = "date", key: str = "account", width: str = "30 days", slide: str = "1 day",
                at_least: int = 2, late: str | None = "1 day") -> DataFrame:
    """Accounts with clusters of returned payments in a sliding window."""
    nsf = _marked(events, time, late).where(F.col("category_primary") == "NSF_OVERDRAFT")
    return (nsf.groupBy(key, F.window(time, width, slide).alias("w")).agg(F.count("*").alias("nsf_count"))
            .where(F.col("nsf_count") >= at_least)
            .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "nsf_count"))


def activity_sessions(events: DataFrame, time: str = "date", key: str = "account", gap: str = "2 days",
                      late: str | None = "1 day") -> DataFrame:
    """Activity sessions per account separated by a gap of silence."""
    return (_marked(events, time, late).groupBy(key, F.session_window(time, gap).alias("w"))
            .agg(F.count("*").alias("n_events"), F.sum("amount").alias("amount"))
            .select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events", "amount"))
