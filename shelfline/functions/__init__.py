"""Column functions (native expressions, no Python UDFs)."""
