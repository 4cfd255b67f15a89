"""Streams of landed files."""
