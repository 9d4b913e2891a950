"""Column functions: strict casts and null-safe arithmetic."""
