"""Training-data operators: scans, deduplication, scoring, language ID and packing.

Nothing outside this subpackage imports it.
"""
