"""Incremental ingest (ST1) and incremental newest-capture-per-stop-event state (ST2)."""
