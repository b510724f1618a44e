"""Declared schemas and readers of the six source tables."""
