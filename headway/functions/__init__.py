"""Column expressions: every function here returns a Column and stays in codegen."""
