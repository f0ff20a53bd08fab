"""Column expressions: no job, no shuffle, no Python in the row path."""
