"""Incremental loads as streams."""
