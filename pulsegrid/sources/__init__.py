"""Readers of device exports and catalogues, each to rows of (recording_id, ts, variable, value) or to a table."""
