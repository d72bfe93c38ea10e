"""Joins of a fact table to a derived, usually small, side.

A per-meter (or per-meter-week) statistics table has as many rows as there
are keys, which grows with the fleet, not with a constant.  So the small side
is checkpointed, its row count and bytes are checked against bounds, and only then is it broadcast; beyond them the join is a sort-merge
join, where AQE's skew-join handling splits a hot key (one meter with a third
of all rows) into several tasks, each paired with the key's single stats row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.config import DEFAULT_BROADCAST_MAX_ROWS, checkpoint_dir


def _max_bytes(spark) -> int:
    """The session's broadcast limit in bytes (-1 disables broadcasting)."""
    v = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for u in sorted(units, key=len, reverse=True):
        if v.endswith(u) and v[:-len(u)].strip().lstrip("-").isdigit():
            return int(v[:-len(u)]) * units[u]
    try:
        return int(v)
    except ValueError:
        return 10 << 20


def row_bytes(df: DataFrame):
    """Bytes of a row: 16 for each column and the text of strings and binaries;
    None when a column's width can't be told (nested types)."""
    total = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind in ("array<double>", "array<bigint>"):
            total = total + 8 * F.coalesce(F.size(f.name), F.lit(0))
        elif kind.startswith(("array", "map", "struct", "variant")):
            return None
    return total


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, now, into a reliable checkpoint of the shared folder."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``big.join(small)`` with a broadcast only after the size is proven.

    The small side is computed once, now, into a reliable checkpoint below
    the shared checkpoint folder (nothing stays cached, and a later call
    computes it anew from the data of that time); its rows and bytes are
    counted there.  Within ``max_rows`` and the session's
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast (no shuffle of
    ``big``); otherwise, or when its width can't be told, a sort-merge join
    is used.  Both ways read the same checkpoint.
    """
    spark = small.sparkSession
    small = checkpointed(small)
    width = row_bytes(small)
    rows, size = small.agg(F.count(F.lit(1)), F.sum(width) if width is not None else F.lit(None)).first()
    if width is not None and rows <= max_rows and (size or 0) <= _max_bytes(spark):
        return big.join(F.broadcast(small), on, how)
    # The checkpoint has no partitioning, so the join shuffles this side on the
    # keys too: AQE only splits a skewed partition (a hot key of the big side)
    # when both join inputs are shuffle stages.
    return big.join(small.hint("shuffle_merge"), on, how)
