"""Column expressions and distributed ordering helpers shared by the operators."""
