"""Event-time windows: tumbling / sliding (stream or batch) and sessions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_agg(df: DataFrame, ts: str, duration: str, aggs: Sequence[Column], by: Sequence[str] = (),
               slide: str | None = None, watermark: str | None = None) -> DataFrame:
    """``groupBy(window(ts, duration[, slide]), by...)``; with ``watermark``
    a streaming query in append mode emits each window once it closes and
    then drops its state.  Output has ``window_start`` / ``window_end``."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    w = F.window(F.col(ts), duration, slide) if slide else F.window(F.col(ts), duration)
    out = df.groupBy(w.alias("w"), *by).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *by, *[c for c in out.columns if c not in ("w", *by)])


def session_agg(df: DataFrame, ts: str, gap: str, by: Sequence[str], aggs: Sequence[Column],
                watermark: str | None = None) -> DataFrame:
    """Gap-based sessions per key (``session_window``).  Sessions are merged
    map-side first when ``spark.sql.streaming.sessionWindow.merge.sessions.
    in.local.partition`` is on, so a busy key is pre-aggregated before the
    shuffle."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    out = df.groupBy(*by, F.session_window(F.col(ts), gap).alias("s")).agg(*aggs)
    return out.select(*by, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                      *[c for c in out.columns if c not in ("s", *by)])
