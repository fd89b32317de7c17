"""Readers of raw records and adapters for the sample tables."""
