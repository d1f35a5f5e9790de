"""Column helpers: every function maps columns to a column, without UDFs."""
