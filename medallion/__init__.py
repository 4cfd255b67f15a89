"""Layered (raw, staging, analytics) e-commerce data runs on PySpark."""
