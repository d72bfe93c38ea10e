"""Evaluate expensive expressions once per row.

A filter on a column derived from ``from_json(value)`` is pushed by the
optimizer below the projection that defines it, and the alias is replaced
by its definition at every reference — one JSON parse per referenced field.
Producing the values from a one-element ``inline`` generator instead keeps
them as real columns: a predicate that references generator output cannot
be pushed below the ``Generate`` node, and the parse runs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, keep: list[str], exprs: dict[str, Column]) -> DataFrame:
    """``df.select(*keep, *exprs)`` where ``exprs`` are computed exactly once."""
    packed = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select(*[F.col(c) for c in keep], F.inline(F.array(packed)))
