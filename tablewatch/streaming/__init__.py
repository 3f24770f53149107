"""Incremental (exactly-once) file-prefix loads on Structured Streaming."""

from tablewatch.streaming.incremental import IncrementalRun, ingest_new_csv_files, ingest_new_json_files

__all__ = ["IncrementalRun", "ingest_new_csv_files", "ingest_new_json_files"]
