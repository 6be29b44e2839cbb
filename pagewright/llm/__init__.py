"""Operators for preparing training text, each an importable module with a
general function, and the queries that apply them to whole tables."""
