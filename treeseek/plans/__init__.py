"""Whole jobs: querying, building and publishing an index, reports."""
