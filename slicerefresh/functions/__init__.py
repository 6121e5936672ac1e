"""Column expressions used by the operators (all built-in, JVM-side)."""

from slicerefresh.functions.predicates import (
    is_clean,
    null_safe_true,
    values_in,
)

__all__ = ["is_clean", "null_safe_true", "values_in"]
