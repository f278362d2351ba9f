"""Column functions: each takes a column and returns a column, all inside code generation."""
