"""Column expressions and the fixed values shared by the operators."""
