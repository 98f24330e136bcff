"""Readers: rows, dead letters and schema issues of each source."""
