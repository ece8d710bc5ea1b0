"""Operators for preparing training text: scans, extraction, dedup, filters, scoring and mixing."""
