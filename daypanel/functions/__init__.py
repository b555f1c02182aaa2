"""Column expressions: calendar parts, period shifts and forecast errors."""
