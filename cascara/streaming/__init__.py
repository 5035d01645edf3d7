"""Structured Streaming forms of the counting jobs."""

from cascara.streaming.tokens import prefix_counts_stream, run_available

__all__ = ["prefix_counts_stream", "run_available"]
