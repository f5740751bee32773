"""Operators for preparing training text: deduplication, filters, scans, tokenization."""
