"""Query catalogue: the library's operators bound to the given tables."""
