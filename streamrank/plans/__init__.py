"""Whole jobs, each from input records to result rows."""
