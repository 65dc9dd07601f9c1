"""Versioned knowledge graphs as plain Spark DataFrames."""
