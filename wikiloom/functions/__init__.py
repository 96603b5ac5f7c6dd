"""Column functions: text cleaning, line handling, template rules."""
