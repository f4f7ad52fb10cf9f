"""DataFrame -> DataFrame operators over events."""
