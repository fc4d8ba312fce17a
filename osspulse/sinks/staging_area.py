"""Lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared checkpoint folder, where lost executors do not matter.

    The folder is the one named in `spark.checkpoint.dir`. Only a local session may do without; it gets one of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="osspulse-checkpoints-")
        context.setCheckpointDir(named)
    return df.checkpoint()
