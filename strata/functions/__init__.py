"""Column functions: all are compositions of built-in functions, there are no UDFs."""
