"""Column expressions on dense ``array<double>`` vectors."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, value: acc + value)


def normal_log_score(point: Column, mean: Column, variance: Column) -> Column:
    """Sum over dimensions of the log normal density.

    NULL if any variance is NULL or 0, as a density is not defined there.
    """
    parts = F.transform(
        F.arrays_zip(point.alias("x"), mean.alias("m"), variance.alias("v")),
        lambda s: F.when(
            s["v"] > 0,
            -0.5 * F.log(2 * math.pi * s["v"])
            - (s["x"] - s["m"]) * (s["x"] - s["m"]) / (2 * s["v"]),
        ),
    )
    return total(parts)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 on an empty denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
