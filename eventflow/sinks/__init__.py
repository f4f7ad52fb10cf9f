"""Sinks: files, tables, databases and shaped records."""
