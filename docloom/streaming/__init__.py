"""Incremental upserts."""
