"""Column functions: money, dates, keys and display text."""
