"""Structured Streaming form of the landing -> raw upsert."""

from tidemark.streaming.upsert_stream import run_stream

__all__ = ["run_stream"]
