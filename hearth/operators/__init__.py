"""Reusable DataFrame -> DataFrame operators (dedupe, rejects, keys, joins, SCD)."""
