"""Loads as file streams."""

from millrace.streaming.file_stream import open_stream, run_stream

__all__ = ["open_stream", "run_stream"]
