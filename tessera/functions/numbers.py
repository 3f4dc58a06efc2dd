"""Rounding as the reports' SQL does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column | str, digits: int) -> Column:
    """value as a double, scaled, rounded half away from zero and scaled back.

    F.round goes by the shortest decimal that a double is shown as, so it makes
    0.0713 of 0.07125; 10,000 times that double is a little below 712.5, so
    engines that round the scaled double, DuckDB among them, have 0.0712.
    """
    scale = float(10**digits)
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double") * scale) / scale
