"""Fixture graphs, registered queries and their oracles."""
