"""Column expressions: null rules, text, times and numbers."""
