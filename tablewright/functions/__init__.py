"""Column expressions and small driver-side helpers."""
