"""Readers for readings, rules and stored tables."""
