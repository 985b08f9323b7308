"""Whole jobs, from raw files to checked tables and reports."""
