"""Operators for preparing training text: mixing, counting, formatting, scoring, packing."""
