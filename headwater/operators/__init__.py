"""Relational operators over the fact tables."""
