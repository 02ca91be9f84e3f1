"""Structured Streaming wiring of the incremental models."""

from stockbook.streaming.micro_batch import stream_into_table

__all__ = ["stream_into_table"]
