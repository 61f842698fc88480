"""Structured Streaming jobs."""

from equiframe.streaming.daily_load import load_batch, start_daily_load

__all__ = ["load_batch", "start_daily_load"]
