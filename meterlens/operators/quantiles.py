"""Exact discrete quantiles per group without gathering a group.

A mergeable sketch brackets each wanted rank between two of its values; a
second pass counts the values below the bracket and groups the few inside it
by value.  Only these are ordered, so a group's window holds a share of about
``6 / accuracy`` of its values, and fewer where values repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.plans.joins import join_small


def group_key(keys: list[str]) -> Column:
    """One text per combination of ``keys``; null is a value of its own."""
    return F.to_json(F.struct(*keys))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    accuracy: int = 10000) -> DataFrame:
    """``_key`` (see ``group_key``) and ``q``, the value of rank ``ceil(p * n)``
    (at least 1) for each of ``probs``, as SQL's ``PERCENTILE_DISC``.

    Null values do not count; a group of nulls alone has no row.  The sketch
    errs by at most ``1 / accuracy`` of the group, the bracket reaches
    ``2 / accuracy`` to both sides, so it always holds the rank.
    """
    v = F.col(value)
    rows = df.select(group_key(keys).alias("_key"), v).filter(v.isNotNull())
    reach = 2.0 / accuracy
    around = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    sketch = (rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"),
                                       F.percentile_approx(v, around, accuracy).alias("_s"))
                  .select("_key", *[F.col("_s")[i].alias(f"_s{i}") for i in range(len(around))],
                          *[F.greatest(F.lit(1), F.col("_n") - F.floor(F.col("_n") - F.lit(p) * F.col("_n")))
                             .cast("long").alias(f"_r{i}") for i, p in enumerate(probs)]))
    # per wanted rank: a null for a value below its bracket, the value inside, nothing above
    hits = F.array(*[
        F.when(v <= F.col(f"_s{2 * i + 1}"),
               F.struct(F.lit(i).alias("i"), F.col(f"_r{i}").alias("rank"),
                        F.when(v >= F.col(f"_s{2 * i}"), v).alias("x")))
        for i in range(len(probs))])
    counts = (join_small(rows, sketch, "_key").select("_key", F.explode(hits).alias("h")).filter("h IS NOT NULL")
              .groupBy("_key", "h.i", "h.rank", "h.x").agg(F.count(F.lit(1)).alias("_c")))
    upto = F.sum("_c").over(Window.partitionBy("_key", "i").orderBy(F.asc_nulls_first("x"))
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counts.withColumn("_upto", upto).filter(F.col("x").isNotNull() & (F.col("_upto") >= F.col("rank")))
    picked = [F.min(F.when(F.col("i") == i, F.col("x"))).alias(f"_q{i}") for i in range(len(probs))]
    return (found.groupBy("_key").agg(*picked)
                 .select("_key", F.array(*[F.col(f"_q{i}") for i in range(len(probs))]).alias("q")))


def interpolated_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                           accuracy: int = 10000) -> DataFrame:
    """``_key`` and ``q`` as SQL's ``PERCENTILE_CONT``: between the values of the ranks
    around ``p * (n - 1)``, counted from 0, in proportion.

    As in ``exact_quantiles`` a sketch brackets both ranks and only the values
    inside are ordered.  Groups of at most ``2 * accuracy`` values keep them all, as
    there a neighbouring rank can lie beyond the sketch's reach.
    """
    v = F.col(value)
    rows = df.select(group_key(keys).alias("_key"), v).filter(v.isNotNull())
    reach = 2.0 / accuracy
    around = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    at = [F.lit(p) * (F.col("_n") - 1) for p in probs]
    wide = F.col("_n") > 2 * accuracy
    sketch = (rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(v, around, accuracy).alias("_s"))
                  .select("_key", *[F.when(wide, F.col("_s")[i]).alias(f"_s{i}") for i in range(len(around))],
                          *[F.floor(a).cast("long").alias(f"_r{i}") for i, a in enumerate(at)],
                          *[(a - F.floor(a)).alias(f"_f{i}") for i, a in enumerate(at)]))
    hits = F.array(*[
        F.when(F.coalesce(v <= F.col(f"_s{2 * i + 1}"), F.lit(True)),
               F.struct(F.lit(i).alias("i"), F.col(f"_r{i}").alias("rank"), F.col(f"_f{i}").alias("part"),
                        F.when(F.coalesce(v >= F.col(f"_s{2 * i}"), F.lit(True)), v).alias("x")))
        for i in range(len(probs))])
    counts = (join_small(rows, sketch, "_key").select("_key", F.explode(hits).alias("h")).filter("h IS NOT NULL")
              .groupBy("_key", "h.i", "h.rank", "h.part", "h.x").agg(F.count(F.lit(1)).alias("_c")))
    upto = F.sum("_c").over(Window.partitionBy("_key", "i").orderBy(F.asc_nulls_first("x"))
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counts.withColumn("_upto", upto).filter("x IS NOT NULL")
    # the smallest value with more than ``rank`` values up to it, and the one with more than ``rank + 1``
    ends = found.groupBy("_key", "i").agg(
        F.max("part").alias("part"), F.min(F.when(F.col("_upto") > F.col("rank"), F.col("x"))).alias("lo"),
        F.min(F.when(F.col("_upto") > F.col("rank") + 1, F.col("x"))).alias("hi"))
    mixed = F.when(F.col("part") > 0, F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).otherwise(F.col("lo"))
    picked = [F.min(F.when(F.col("i") == i, F.col("_m"))).alias(f"_q{i}") for i in range(len(probs))]
    return (ends.withColumn("_m", mixed).groupBy("_key").agg(*picked)
                .select("_key", F.array(*[F.col(f"_q{i}") for i in range(len(probs))]).alias("q")))
