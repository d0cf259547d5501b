"""Binary search in sorted arrays, as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_at_most(array: Column, value: Column, longest: int) -> Column:
    """How many elements of a rising array of at most `longest` elements are not above the value."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, longest.bit_length())))])
    size = F.size(array)
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= size) & (F.get(array, at + step - 1) <= value), at + step).otherwise(at)
    )
