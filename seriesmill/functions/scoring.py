"""Scalar expressions shared by the scorers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(value: Column) -> Column:
    """NaN becomes NULL. Spark orders NaN above every number, so comparisons need this first."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def hit(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it fails or is NULL."""
    return F.when(condition, 1.0).otherwise(0.0)


def inside_interval(y: Column, lower: Column, upper: Column) -> Column:
    """Strictly between the bounds; a missing bound or value is a miss."""
    return hit((usable(lower) < usable(y)) & (usable(y) < usable(upper)))


def below_upper(y: Column, upper: Column) -> Column:
    return hit(usable(y) < usable(upper))
