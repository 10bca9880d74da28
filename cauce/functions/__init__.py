"""Column-expression helpers. All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from cauce.functions.columns import (
    elapsed_days,
    is_temporal,
    minus_days,
    minus_months,
    number,
    ratio,
    round_doubles,
    sigmoid,
    last_non_null,
)

__all__ = [
    "elapsed_days", "is_temporal", "minus_days", "minus_months", "number", "ratio",
    "round_doubles", "sigmoid", "last_non_null",
]
