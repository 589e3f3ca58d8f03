"""Column functions: missing values, text and names, statistics."""
