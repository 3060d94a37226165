"""Reusable DataFrame transformations the plans are built from."""
