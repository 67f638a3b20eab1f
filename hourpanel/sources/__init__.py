"""Declared schemas, readers, ingest rules and sinks."""
