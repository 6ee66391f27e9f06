"""Structured Streaming driver of the incremental load."""

from clickweir.streaming.micro_batch import start_stream

__all__ = ["start_stream"]
