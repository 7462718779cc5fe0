"""Batch sources and sinks, table management, and the test-table mapping."""
