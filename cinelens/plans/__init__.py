"""Composite flows built from operators."""
