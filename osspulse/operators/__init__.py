"""Frame-to-frame building blocks."""

from osspulse.operators.filters import (
    after_watermark,
    by_dates,
    by_repos,
    recent_groups,
    since,
    watermark,
)
from osspulse.operators.history import OPEN_END, scd2_snapshot
from osspulse.operators.joins import lookup_join, scd2_join, spread_null
from osspulse.operators.latest import latest_per_key
from osspulse.operators.merge import delete_insert, latest_in_batch, upsert
from osspulse.operators.nested import child_rows, flatten_struct
from osspulse.operators.runs import expand_runs, weighted_median
from osspulse.operators.selection import exact_median

__all__ = [
    "OPEN_END",
    "after_watermark",
    "by_dates",
    "by_repos",
    "child_rows",
    "delete_insert",
    "exact_median",
    "expand_runs",
    "flatten_struct",
    "latest_in_batch",
    "latest_per_key",
    "lookup_join",
    "recent_groups",
    "scd2_join",
    "scd2_snapshot",
    "since",
    "spread_null",
    "upsert",
    "watermark",
    "weighted_median",
]
