"""Whole loads: dimensions, facts and file repairs."""
