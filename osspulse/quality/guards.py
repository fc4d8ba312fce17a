"""Checks measured by a write itself, which decide whether its rows become visible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from osspulse.quality.checks import Check


class ChecksFailed(Exception):
    """Checks of severity `error` have violations."""


class WriteGuard:
    """Row checks and bounds of the row count, counted by the tasks that write a frame.

    `watch` adds the counts to the frame that is written, `verify` reads them after the write. Each partition counts once, however
    often its task is repeated, as the frame is watched right before the write. Checks that one row cannot decide, and that
    are no row count, are left to `run_checks`. One guard serves one write.
    """

    def __init__(self, suite: Sequence[Check]):
        self.suite = [check for check in suite if check.row_fails is not None or check.bounds is not None]
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(c.row_fails).alias(f"c{i}") for i, c in enumerate(self.suite) if c.row_fails is not None]
        return df.observe(self.observation, F.count(F.lit(1)).alias("n_rows"), *counts)

    @property
    def rows(self) -> int:
        """Rows written."""
        return self.observation.get.get("n_rows") or 0

    def results(self) -> list[tuple[str, str, int, str]]:
        """`check, severity, violations, status` as `run_checks` has them."""
        found = []
        for i, check in enumerate(self.suite):
            if check.row_fails is None:
                low, high = check.bounds
                violations = int(self.rows < low or (high is not None and self.rows > high))
            else:
                violations = self.observation.get.get(f"c{i}") or 0
            found.append((check.name, check.severity, violations, check.severity if violations else "pass"))
        return found

    def verify(self) -> None:
        failed = [f"{name}: {violations}" for name, _, violations, status in self.results() if status == "error"]
        if failed:
            raise ChecksFailed("; ".join(failed))
