"""Scoring requests as a Structured Streaming job."""

from .scoring_stream import start_scoring_stream  # noqa: F401
