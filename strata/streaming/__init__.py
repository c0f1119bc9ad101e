"""Structured Streaming form of the landing -> bronze -> silver load."""

from strata.streaming.landing_stream import start_table_stream, stream_tables

__all__ = ["start_table_stream", "stream_tables"]
