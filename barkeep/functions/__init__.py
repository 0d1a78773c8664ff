"""Column expressions and driver-side date arithmetic."""
