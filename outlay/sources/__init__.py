"""Landing files, raw tables, marts and JSON products."""
