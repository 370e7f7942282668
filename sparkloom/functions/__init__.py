"""Column functions: text, time, numbers, JSON."""
