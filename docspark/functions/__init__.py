"""Column functions: scalar rules, JSON Schema, pandas hooks."""
