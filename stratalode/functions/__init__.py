"""Column expressions and schema rules shared by the operators."""
