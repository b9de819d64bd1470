"""Column expressions: every function here takes and returns a Column."""
