"""Readers of raw files, curated tables and control files."""
