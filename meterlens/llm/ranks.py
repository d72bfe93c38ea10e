"""Positions of rows within their tree, by one range shuffle.

No window over a whole tree: rows are range-partitioned on (tree, order), so
that one large tree spreads over many tasks; every task counts its own runs,
and one row per task says how long its first and last run are.  Their prefix
sums, made on the driver from that one row per task, move the first run of a
task behind the rows of the same tree in earlier tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from meterlens.llm.util import written


def ranked(df: DataFrame, tree: str, order: list, name: str) -> DataFrame:
    """``df`` and ``rank`` (long, from 0 within ``tree``, by ``order``).

    ``tree`` must not be null; rows equal in ``order`` rank in any order.
    ``df`` is read twice (once for the range bounds), so it should be a table.
    """
    by = [F.col(tree).asc(), *order]
    schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
    sorted_rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    names = df.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, run, first_run, part, kinds = None, 0, None, None, None
        first_tree = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(tree)
            part, kinds = b.column("_part")[0], [b.column(c).type for c in names]
            change = np.empty(b.num_rows, bool)
            change[0] = last is None or keys[0] != last
            if b.num_rows > 1:
                change[1:] = pc.not_equal(keys.slice(1), keys.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            if last is None:
                first_tree = keys[0]
            starts = np.flatnonzero(change)
            place = np.arange(b.num_rows)
            begin = np.zeros(b.num_rows, np.int64)
            begin[starts] = starts
            begin = np.maximum.accumulate(begin)
            rank = place - begin
            lead = int(starts[0]) if len(starts) else b.num_rows
            rank[:lead] += run
            head = np.zeros(b.num_rows, bool)
            if first_run is None:  # still in the task's first run, at least at the batch's start
                stop = lead if last is not None else (int(starts[1]) if len(starts) > 1 else b.num_rows)
                head[:stop] = True
                if stop < b.num_rows or (last is not None and lead < b.num_rows):
                    first_run = int(rank[stop - 1]) + 1 if stop else run
            last, run = keys[b.num_rows - 1], int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [b.column("_part"), pa.array(rank), pa.array(head)], [*names, "_part", "rank", "_head"])
        if last is None:
            return
        # two rows on the task: its first run, and its last with a count below zero
        for key, n in ((first_tree, run if first_run is None else first_run), (last, -run)):
            cells = [pa.array([key.as_py()], t) if c == tree else pa.nulls(1, t) for c, t in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays([*cells, pa.array([part.as_py()], pa.int32()), pa.array([n], pa.int64()),
                                              pa.nulls(1, pa.bool_())], [*names, "_part", "rank", "_head"])

    out = StructType([*schema.fields, *StructType().add("_part", "integer").add("rank", "long").add("_head", "boolean").fields])
    counted = written(sorted_rows.mapInArrow(count, out), name)
    facts: dict[int, list] = {}
    for r in counted.filter("_head IS NULL").select("_part", tree, "rank").collect():  # two rows a task
        facts.setdefault(r[0], [None, None])[r[2] < 0] = (r[1], abs(r[2]))
    offsets, at, before = [], None, 0
    for part in sorted(facts):
        first, last = facts[part]
        moved = before if first[0] == at else 0
        if moved:
            offsets.append((part, moved))
        before = moved + last[1] if last[0] == first[0] else last[1]
        at = last[0]
    rows = counted.filter("_head IS NOT NULL")
    if not offsets:
        return rows.drop("_part", "_head")
    small = df.sparkSession.createDataFrame(offsets, "_part int, _moved long")  # at most one row a task
    return (rows.join(F.broadcast(small), "_part", "left")
                .withColumn("rank", F.col("rank") + F.when(F.col("_head"), F.coalesce("_moved", F.lit(0))).otherwise(0))
                .drop("_part", "_head", "_moved"))
