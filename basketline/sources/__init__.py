"""Readers, writers and the lineage log."""
