"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key format: the text that stands for NULL, and the separator.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def surrogate_key(*natural_key: Column) -> Column:
    """md5 hex of the natural key in text form.

    Dates read `2024-01-31` and timestamps `2024-01-31 10:00:00` (UTC) in the key text.
    """
    parts = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_TOKEN)) for part in natural_key]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
