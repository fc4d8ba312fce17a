"""As-of join by an ordered merge of versions and events.

Both go into one stream that is range-partitioned and sorted by key and day, versions before the events of their first day. The newest version
before an event is then the last one seen in the stream: within a partition a running value, and at its start the
last version of the partitions before. No event is compared with more than one version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from osspulse.sinks.staging_area import cut_lineage


def ordered_asof(
    events: DataFrame,
    versions: DataFrame,
    event_keys: Sequence[str],
    day: str,
    version_keys: Sequence[str],
    valid_from: str,
    valid_to: str,
    take: Sequence[str],
    prefix: str = "",
) -> DataFrame:
    """Left join of each event with the version of its key that is in force: `valid_from <= day < valid_to`.

    Versions of a key do not overlap, but they may have gaps, and empty ranges are in force on no day. Events without a
    key or day match nothing. A key with most rows is spread over many partitions, as these split between days.
    """
    taken = [f"_take{i}" for i in range(len(take))]
    keys = [f"_key{i}" for i in range(len(event_keys))]
    right = versions.filter(F.col(valid_from) < F.col(valid_to)).select(
        *(F.col(c).alias(k) for c, k in zip(version_keys, keys, strict=True)),
        F.col(valid_from).alias("_day"),
        F.struct(F.col(valid_to).alias("_to"), *(F.col(c).alias(t) for c, t in zip(take, taken, strict=True))).alias("_version"),
    )
    left = events.select(
        *(F.col(c).alias(k) for c, k in zip(event_keys, keys, strict=True)), F.col(day).alias("_day"), F.struct(*events.columns).alias("_event")
    )
    both = left.unionByName(right, allowMissingColumns=True)
    # A hash of the row spreads events of one key and day over partitions, too; versions of that day come first.
    late = F.col("_event").isNotNull()
    spread = F.when(late, F.xxhash64("_event")).otherwise(F.lit(-(2**63)))
    streamed = both.withColumns({"_late": late, "_spread": spread})
    order = [*keys, "_day", "_late", "_spread"]
    streamed = streamed.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut_lineage(streamed.withColumn("_at", F.monotonically_increasing_id()).drop("_spread"))

    # Each partition's last version, and what is open at the start of the next ones: a value per partition.
    part = F.shiftright("_at", 33).alias("_part")
    seen = F.when(~F.col("_late"), F.struct(*keys, "_version"))
    last = rows.groupBy(part).agg(F.max_by(seen, F.when(~F.col("_late"), F.col("_at"))).alias("_open"))
    starts, open_ = [], None
    for end in last.orderBy("_part").collect():
        starts.append((end["_part"], open_))
        open_ = end["_open"] or open_
    opens = events.sparkSession.createDataFrame(starts, last.schema)

    # Sorted by partition and place already; a window task holds the rows of one of them at a time.
    running = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    merged = rows.withColumn("_part", part).join(F.broadcast(opens), "_part")
    merged = merged.withColumn("_seen", F.coalesce(F.last(seen, ignorenulls=True).over(running), F.col("_open")))
    in_force = _same(keys) & (F.col("_day") < F.col("_seen._version._to")) & F.col("_day").isNotNull()
    picked = [F.when(in_force, F.col(f"_seen._version.{t}")).alias(prefix + c) for c, t in zip(take, taken, strict=True)]
    return merged.filter("_late").select("_event.*", *picked)


def _same(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for key in keys:
        out = out & (F.col(f"_seen.{key}") == F.col(key))
    return F.coalesce(out, F.lit(False))
