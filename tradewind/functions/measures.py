"""Ratios of measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_PER_KILO = "price_per_kilo"


def safe_ratio(a: Column, b: Column, zero_weight: str = "null") -> Column:
    """``a / b`` as double. Division by zero gives NULL, or Infinity/NaN with ``zero_weight="ieee"``."""
    ratio = F.try_divide(a.cast("double"), b.cast("double"))
    if zero_weight == "null":
        return ratio
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    at_zero = F.when(a > 0, inf).when(a < 0, -inf).when(a == 0, nan)
    return F.when(b == 0, at_zero).otherwise(ratio)
