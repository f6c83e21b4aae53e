"""Column expressions: recodes, keys and column-list helpers."""
