"""Streaming forms of the incremental loads."""

from osspulse.streaming.loads import start_history, start_load

__all__ = ["start_history", "start_load"]
