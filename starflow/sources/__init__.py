"""Sources: positional CSV, seeds, newest-file selection, table scans, page extraction."""
