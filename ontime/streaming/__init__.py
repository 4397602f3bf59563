"""Structured Streaming form of the ingest stage."""

from ontime.streaming.ingest import ingest_stream, read_csv_stream, run_until_caught_up  # noqa: F401
