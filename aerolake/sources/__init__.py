"""Readers: snapshots, registry, fuel rates, prepared tables, file listings."""
