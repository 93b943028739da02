"""Column functions: boxes, text and SQL registration."""
