"""Audit operators: every function maps DataFrames to a DataFrame and runs no action."""
