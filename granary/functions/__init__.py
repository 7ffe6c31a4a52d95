"""Column functions: columns and parameters in, columns out; no UDFs."""
