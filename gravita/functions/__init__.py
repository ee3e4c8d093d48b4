"""Column expressions. All stay inside whole-stage codegen; none is a Python function of rows."""
