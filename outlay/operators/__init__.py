"""Operators over any table: columns are parameters, nothing is tied to one source."""
