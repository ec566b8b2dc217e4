"""Formats, metrics and other column functions."""
