"""Table readers, quarantine of malformed rows, and writers."""
