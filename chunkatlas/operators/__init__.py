"""Relational operators over the metadata tables."""
