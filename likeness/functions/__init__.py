"""Column-level helpers (hashes, canonical pairs)."""
