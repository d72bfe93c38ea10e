"""Column builders: features, rule predicates, live scoring."""

from meterlens.functions.features import add_features
from meterlens.functions.rules import apply_rules, score_live

__all__ = ["add_features", "apply_rules", "score_live"]
