"""Reading and writing tables, models and raw files."""
