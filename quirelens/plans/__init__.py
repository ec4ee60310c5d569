"""Input tables derived from given ones, and the registry of queries with their SQL checks."""
