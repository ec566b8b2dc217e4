"""Primitives, iteration and algorithms."""
