"""Streaming forms of operators with state (an extension: the batch rules, row by row).

Input arrives in event order for each key, or is put in order within a micro-batch; state is a few
numbers a key and is dropped by a timeout."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def greedy_keep_stream(rows: DataFrame, threshold: float, key: str = "video_id", timeout_ms: int = 3_600_000) -> DataFrame:
    """rows(key, ts double, v double): those that differ from the last kept one by the threshold (Q01)."""
    kind = rows.schema[key].dataType.simpleString()

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        out = []
        for f in pd.concat(list(frames)).sort_values("ts").itertuples():
            if last is None or abs(f.v - last) >= threshold:
                last = f.v
                out.append((k[0], f.ts, f.v))
        state.update((last,))
        state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=[key, "ts", "v"])

    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, ts double, v double", "last double", "append", GroupStateTimeout.ProcessingTimeTimeout)


def hover_stream(hits: DataFrame, gap: float, least: float, key: str = "video_id", timeout_ms: int = 3_600_000) -> DataFrame:
    """hits(key, ts double, element string): islands of one element that are over."""
    kind = hits.schema[key].dataType.simpleString()

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else None
        out = []

        def close(s):
            if s and s[2] - s[1] >= least:
                out.append((k[0], s[0], s[1], s[2]))

        if state.hasTimedOut:
            close(now)
            state.remove()
        else:
            for f in pd.concat(list(frames)).sort_values("ts").itertuples():
                if now and now[0] == f.element and f.ts - now[2] <= gap:
                    now = (now[0], now[1], f.ts)
                else:
                    close(now)
                    now = (f.element, f.ts, f.ts)
            state.update(now)
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=[key, "element", "start", "end"])

    out = f"{key} {kind}, element string, start double, end double"
    return hits.groupBy(key).applyInPandasWithState(step, out, "element string, start double, end double", "append", GroupStateTimeout.ProcessingTimeTimeout)


def windowed_counts(rows: DataFrame, ts: str = "ts", late: str = "10 minutes", length: str = "5 minutes", *keys: str) -> DataFrame:
    """Counts by event-time window with a watermark; a time without a zone is read as UTC."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, length), *keys).agg(F.count(F.lit(1)).alias("n")).select("window.start", "window.end", *keys, "n")
