"""Column expressions shared by the operators (all built-in, JVM side)."""

from tidemark.functions.expr import (
    any_failed,
    bucket,
    capture_time,
    reasons,
    to_change_time,
    valid_op,
)

__all__ = [
    "any_failed",
    "bucket",
    "capture_time",
    "reasons",
    "to_change_time",
    "valid_op",
]
