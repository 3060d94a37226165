"""Delivering results as topics, dated files and an accumulated table."""
