"""Readers: landed API pages, relational orders, generated sample orders."""
