"""Operators of a training-data pipeline (scans, scoring, packing, dedup)."""
