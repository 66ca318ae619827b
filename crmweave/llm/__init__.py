"""Operators that prepare training text: dedup, scans, counting, filtering and packing."""
