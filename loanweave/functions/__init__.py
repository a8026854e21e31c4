"""Column expressions: no joins, no actions, no Python per row."""
