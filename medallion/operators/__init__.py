"""Operators on frames and tables: dedup, aggregates, quality, loads, merge."""
