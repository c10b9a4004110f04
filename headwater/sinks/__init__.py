"""Sinks: external systems, versioned tables, text, and lineage documents."""
