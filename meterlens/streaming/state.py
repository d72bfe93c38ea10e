"""Stateful streaming rolling baseline (per meter and time bucket, event time).

State and groups are keyed by (meter, bucket): a reading whose window's
successors may lie in the next bucket goes there too, as context.  So a
micro-batch of one busy meter spreads over its buckets, and no state holds
more than a bucket and a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor, StatefulProcessorHandle, TimerValues,
)

from meterlens.config import WATERMARK_DELAY
from meterlens.plans.windows import _micros
from meterlens.streaming.rollups import with_watermark

OUT_SCHEMA = ("meter_id string, timestamp string, event_time timestamp, consumption_kwh double, "
              "rolling_mean_kwh double, rolling_count long")
#: Groups that a meter's undated rows spread over.
UNDATED = 16
STATE_SCHEMA = "ts array<long>, kwh array<double>"


def _rolling_step(h_ts: np.ndarray, h_kwh: np.ndarray, batch: pd.DataFrame, window_us: int):
    """Means of ``[t - window, t)`` for the batch rows over history + batch.

    NaN and infinite readings are missing ones.  Each window is summed by
    itself, so no reading outside a window can blur its mean.  Returns the
    output frame and the merged, time-sorted (ts, kWh) arrays.
    """
    shown = ~batch["context"].astype(bool).to_numpy() if "context" in batch else slice(None)
    us = batch["event_us"]
    known = us.notna().to_numpy()
    b_ts = us.fillna(0).astype("int64").to_numpy()
    kwh = batch["consumption_kwh"].astype(float).to_numpy()
    good = known & np.isfinite(kwh)
    all_ts = np.concatenate([h_ts, b_ts[good]])
    all_kwh = np.concatenate([h_kwh, kwh[good]])
    order = np.argsort(all_ts, kind="stable")
    all_ts, all_kwh = all_ts[order], all_kwh[order]
    lo = np.searchsorted(all_ts, b_ts - window_us, side="left")
    hi = np.searchsorted(all_ts, b_ts, side="left")
    cnt = np.where(known, hi - lo, 0)
    mean = np.full(len(batch), np.nan)
    rows = np.flatnonzero(cnt > 0)
    rows = rows[np.argsort(b_ts[rows], kind="stable")]  # in time order the gaps between windows are short
    if len(rows):
        ends = np.stack([lo[rows], hi[rows]], axis=1).ravel()
        mean[rows] = np.add.reduceat(np.append(all_kwh, 0.0), ends)[::2] / cnt[rows]
    out = pd.DataFrame({
        "meter_id": batch["meter_id"], "timestamp": batch["timestamp"],
        "event_time": batch["event_time"], "consumption_kwh": kwh,
        "rolling_mean_kwh": np.round(mean, 6), "rolling_count": pd.arrays.IntegerArray(cnt.astype("int64"), ~known)})
    return out[shown], all_ts, all_kwh


def _bucketed(readings: DataFrame, window_us: int, bucket_us: int) -> DataFrame:
    """Rows with the bucket they belong to, and again, as context, in the next
    one where they lie within a window of it.  Undated rows have no window;
    they spread over buckets below zero by their hash."""
    if window_us > bucket_us:
        raise ValueError("bucket must be at least as wide as the window")
    us = F.unix_micros("event_time")
    own = F.floor(us / bucket_us).cast("long")
    spread = (-1 - F.pmod(F.xxhash64("timestamp", "consumption_kwh"), F.lit(UNDATED))).cast("long") - (1 << 40)
    tail = us - own * bucket_us >= bucket_us - window_us
    df = readings.select("meter_id", "timestamp", "event_time", "consumption_kwh", us.alias("event_us"),
                         F.coalesce(own, spread).alias("own"),
                         F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(F.coalesce(own, spread)))).alias("bucket"))
    return df.withColumn("context", F.col("bucket") != F.col("own")).drop("own")


def _rolling_fn(window_us: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            h_ts, h_kwh = state.get
            h_ts, h_kwh = np.asarray(h_ts, dtype=np.int64), np.asarray(h_kwh, dtype=float)
        else:
            h_ts, h_kwh = np.empty(0, np.int64), np.empty(0, float)
        batch = pd.concat(list(pdfs), ignore_index=True)
        out, all_ts, all_kwh = _rolling_step(h_ts, h_kwh, batch, window_us)
        # keep only what a future on-time row can still need
        wm_us = max(state.getCurrentWatermarkMs(), 0) * 1000
        keep = all_ts >= wm_us - window_us
        if keep.any():
            state.update((all_ts[keep].tolist(), all_kwh[keep].tolist()))
            state.setTimeoutTimestamp(int(all_ts[keep].max() // 1000 + window_us // 1000) + 1)
        elif state.exists:
            state.remove()
        yield out
    return fn


class RollingBaselineProcessor(StatefulProcessor):
    """``transformWithStateInPandas`` form: history in a ``ListState`` of
    (time, kWh), evicted below ``watermark - window``; an event-time timer
    clears the state of a meter that has gone quiet."""

    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hist = handle.getListState("hist", "ts long, kwh double")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        hist = list(self.hist.get()) if self.hist.exists() else []
        h_ts = np.array([h[0] for h in hist], dtype=np.int64)
        h_kwh = np.array([h[1] for h in hist], dtype=float)
        batch = pd.concat(list(rows), ignore_index=True)
        out, all_ts, all_kwh = _rolling_step(h_ts, h_kwh, batch, self.window_us)
        wm_us = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
        keep = all_ts >= wm_us - self.window_us
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        if keep.any():
            self.hist.put([(int(t), float(v)) for t, v in zip(all_ts[keep], all_kwh[keep])])
            self.handle.registerTimer(int(all_ts[keep].max() // 1000 + self.window_us // 1000) + 1)
        else:
            self.hist.clear()
        yield out

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo):
        self.hist.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_rolling_baseline(readings: DataFrame, window: str = "30 minutes",
                            watermark: str = WATERMARK_DELAY, bucket: str = "1 hour") -> DataFrame:
    """Streaming version of ``rolling_baseline``: per meter, mean kWh of the
    readings in ``[t - window, t)`` seen so far.

    A group is one meter's ``bucket`` of time.  Its state holds only readings newer than
    ``watermark - window`` and is dropped by an event-time timeout, so it is
    bounded by the data rate, not by history.  With in-order input the
    values equal the batch operator; a reading arriving after later ones
    does not revise rows already emitted (append mode).
    """
    w_us = _micros(window)
    df = _bucketed(with_watermark(readings, watermark), w_us, _micros(bucket))
    return df.groupBy("meter_id", "bucket").applyInPandasWithState(
        _rolling_fn(w_us), OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)


def stream_rolling_baseline_tws(readings: DataFrame, window: str = "30 minutes",
                                watermark: str = WATERMARK_DELAY, bucket: str = "1 hour") -> DataFrame:
    """Same result as ``stream_rolling_baseline`` with ``transformWithStateInPandas``
    (list state + event-time timers).  Needs the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``)."""
    w_us = _micros(window)
    df = _bucketed(with_watermark(readings, watermark), w_us, _micros(bucket))
    return df.groupBy("meter_id", "bucket").transformWithStateInPandas(
        RollingBaselineProcessor(w_us), OUT_SCHEMA, "Append", "EventTime")
