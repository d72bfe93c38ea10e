"""Plan helpers: size-checked broadcast joins and skew-safe range windows."""

from meterlens.plans.barrier import materialize
from meterlens.plans.joins import join_small, row_bytes
from meterlens.plans.windows import preceding_range_agg, epoch_micros

__all__ = ["join_small", "row_bytes", "materialize", "preceding_range_agg", "epoch_micros"]
