"""Column expressions: every function takes Columns and returns a Column."""
