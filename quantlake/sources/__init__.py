"""Scans, sinks, catalog tables and input adapters."""
