"""Sinks: console, bucketed files, queue, JDBC, idempotent batches, custom."""
