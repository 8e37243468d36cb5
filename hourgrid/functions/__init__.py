"""Column expressions: calendar, measures."""
