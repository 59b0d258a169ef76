"""Column expressions: everything here maps Columns to a Column."""
