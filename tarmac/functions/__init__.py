"""Column expressions: everything here maps columns to a column."""
