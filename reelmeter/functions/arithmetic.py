"""Small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(x: Column | str, n: Column | int) -> Column:
    """Whole quotient of two non-negative integers, without going through doubles."""
    x = F.col(x) if isinstance(x, str) else x
    n = n if isinstance(n, Column) else F.lit(n)
    return F.call_function("div", x, n)


def evaluated_once(fn):
    """A Python function that filters and generators may not copy.

    The optimizer repeats a deterministic expression inside a filter it pushes
    down or infers, which for Python code means a second trip through Arrow.
    """
    return fn.asNondeterministic()
