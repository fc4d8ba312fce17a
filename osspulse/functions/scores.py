"""Pieces of the 0..1 component scores."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_ratio(value: Column, reference: float) -> Column:
    """Log-scaled share of `reference`; negatives count as zero, 1.0 is the ceiling."""
    scaled = F.log1p(F.greatest(value.cast("double"), F.lit(0.0)))
    return F.least(scaled / F.lit(math.log1p(reference)), F.lit(1.0))


def clip_unit(value: Column) -> Column:
    """Limit to [0, 1]; NULL stays NULL."""
    number = value.cast("double")
    return F.when(number < 0, 0.0).when(number > 1, 1.0).otherwise(number)


def half_life_decay(age: Column, half_life: float) -> Column:
    """1 at age 0, halved every `half_life`; an unknown age scores 0."""
    return F.coalesce(F.pow(F.lit(0.5), age.cast("double") / F.lit(half_life)), F.lit(0.0))


def share_of_true(true_count: Column, known_count: Column) -> Column:
    """`true_count / known_count` as a double; NULL when nothing is known."""
    return F.when(known_count > 0, true_count.cast("double") / known_count.cast("double"))
