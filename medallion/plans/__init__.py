"""Whole plans: entity transforms, layer builds, control log, runs."""
