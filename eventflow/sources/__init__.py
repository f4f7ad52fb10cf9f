"""Sources: files, growing files, tables, message records and payloads, as events."""
