"""Column functions: text rules and time arithmetic."""
