"""Column functions: geometry, cost models, text and bit helpers.  No Python UDFs."""
