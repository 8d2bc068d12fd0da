"""Column expressions: statistics, hashing, calendar, text."""
