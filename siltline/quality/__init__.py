"""Data checks. Each is a rule; :func:`violations` gives the rows that break it and
:class:`Suite` runs many rules with as few scans as they allow."""

from .rules import (
    FrameRule, GroupRule, RowRule, Rule, accepted_range, accepted_values, assert_equal,
    at_least_one, expression_is_true, not_accepted_values, not_constant, not_empty_string, not_null,
    not_null_proportion, recency, unique, unique_combination, violations,
)
from .suite import Suite
from .tables import (
    cardinality_equality, columns_match, equal_rowcount, equality, fewer_rows_than,
    mutually_exclusive_ranges, relationships_where, sequential_values,
)

__all__ = [
    "FrameRule", "GroupRule", "RowRule", "Rule", "Suite", "accepted_range", "accepted_values",
    "assert_equal", "at_least_one", "cardinality_equality", "columns_match", "equal_rowcount",
    "equality", "expression_is_true", "fewer_rows_than", "mutually_exclusive_ranges",
    "not_accepted_values", "not_constant", "not_empty_string", "not_null", "not_null_proportion",
    "recency", "relationships_where", "sequential_values", "unique", "unique_combination",
    "violations",
]
