"""End-to-end pipeline and the registered queries with their SQL checks."""
