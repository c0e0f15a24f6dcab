"""Structured Streaming: exactly-once discovery of landed files."""

from layerkit.streaming.discovery import good_rows, ingest_new_files, rejected_rows

__all__ = ["good_rows", "ingest_new_files", "rejected_rows"]
