"""Structured Streaming: bronze, quarantine and bar queries."""

from ticksmith.streaming.jobs import (DEFAULT_DELAY, bar_stream, bronze_file_stream, bronze_stream,
                                      file_stream, heartbeat_stream, quarantine_stream, run_available_now,
                                      start_bars, start_bars_from_bronze, start_bronze, start_ingest,
                                      start_quarantine, use_rocksdb_state_store)

__all__ = [
    "DEFAULT_DELAY", "bar_stream", "bronze_file_stream", "bronze_stream", "file_stream", "heartbeat_stream", "quarantine_stream",
    "run_available_now", "start_bars", "start_bars_from_bronze", "start_bronze", "start_ingest", "start_quarantine",
    "use_rocksdb_state_store",
]
