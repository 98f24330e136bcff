"""Deliverable files."""
