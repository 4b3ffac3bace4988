"""Operators for training text: deduplication, filters, formatting, mixing."""
