"""File and event streams, routing, incremental views."""
