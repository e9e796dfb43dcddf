"""Column functions: patterns, cleaning, tokenising, arrays."""
