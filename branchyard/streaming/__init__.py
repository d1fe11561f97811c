"""Bounded file streams into a ref."""

from branchyard.streaming.ingest import stream_files

__all__ = ["stream_files"]
