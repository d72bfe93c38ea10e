"""Time-range windows that do not put a whole key into one task.

``Window.partitionBy("meter_id")`` sends every reading of a meter to one
task; a meter holding a third of the data would then be sorted by a single
core.  Instead each key's time line is cut into fixed buckets and the rows of
the last ``window`` of a bucket are repeated, marked as context, at the head
of the next bucket.  Partitions are (key, bucket): bounded by the bucket
width, spread over the cluster, and a row's preceding range is always inside
its own partition.  Extra rows = window / bucket of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone."""
    dt = df.schema[col].dataType
    if isinstance(dt, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{col}`)")
    if isinstance(dt, TimestampType):
        return F.unix_micros(F.col(col))
    raise TypeError(f"{col} is {dt}, expected a timestamp")


def _micros(interval: str) -> int:
    n, unit = interval.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s").lower()]
    return int(float(n) * scale * 1_000_000)


def preceding_range_agg(df: DataFrame, key: str, ts: str, aggs: dict[str, Column],
                        window: str = "30 minutes", bucket: str = "6 hours") -> DataFrame:
    """Add ``aggs`` computed over rows of the same key with time in
    ``[t - window, t)`` (the current row and exact ties excluded).

    ``aggs`` are window-able aggregate columns, e.g. ``F.avg("kwh")``.  Rows
    without a time have no range: they go around the window with null aggregates,
    so they are neither shuffled nor gathered in one partition.
    """
    w_us, b_us = _micros(window), _micros(bucket)
    if w_us > b_us:
        raise ValueError("bucket must be at least as wide as the window")
    undated = df.filter(F.col(ts).isNull())
    t = epoch_micros(df, ts)
    df = df.filter(F.col(ts).isNotNull()).withColumn("__t", t).withColumn("__b", F.floor(F.col("__t") / b_us))
    is_tail = F.col("__t") - F.col("__b") * b_us >= b_us - w_us
    df = df.withColumn(
        "__bk", F.explode(F.when(is_tail, F.array(F.col("__b"), F.col("__b") + 1))
                           .otherwise(F.array(F.col("__b")))))
    w = Window.partitionBy(key, "__bk").orderBy("__t").rangeBetween(-w_us, -1)
    df = df.withColumns({name: agg.over(w) for name, agg in aggs.items()})
    df = df.filter(F.col("__bk") == F.col("__b"))
    return df.drop("__t", "__b", "__bk").unionByName(undated, allowMissingColumns=True)
