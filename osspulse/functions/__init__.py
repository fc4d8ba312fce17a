"""Column functions."""

from osspulse.functions.dates import (
    date_key,
    day_diff,
    day_name,
    day_of_week,
    hour_diff,
    month_diff,
    month_label,
    month_name,
    month_start,
    utc_literal,
    utc_naive,
)
from osspulse.functions.keys import NULL_KEY_TOKEN, surrogate_key
from osspulse.functions.scores import clip_unit, half_life_decay, log_ratio, share_of_true

__all__ = [
    "NULL_KEY_TOKEN",
    "clip_unit",
    "date_key",
    "day_diff",
    "day_name",
    "day_of_week",
    "half_life_decay",
    "hour_diff",
    "log_ratio",
    "month_diff",
    "month_label",
    "month_name",
    "month_start",
    "share_of_true",
    "surrogate_key",
    "utc_literal",
    "utc_naive",
]
