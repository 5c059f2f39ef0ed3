"""Column functions: dates, numbers, text, tags and structured answers."""
