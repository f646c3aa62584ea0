"""Column expressions. They are all built-in Spark functions and stay inside generated code."""
