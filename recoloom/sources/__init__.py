"""Sources and sinks: table scans, canonical views, validation, writers."""
