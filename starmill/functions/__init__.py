"""Column functions: dates, numbers, text."""
