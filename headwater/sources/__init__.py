"""Scans: job facts, files, and external systems."""
