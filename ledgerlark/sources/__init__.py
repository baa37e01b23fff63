"""Table declarations, file scans and sinks."""
