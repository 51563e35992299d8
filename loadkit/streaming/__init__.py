"""Incremental loads with resume and progress."""
