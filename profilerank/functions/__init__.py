"""Column functions: dates, numbers, text, ordinals, keyword families, model responses."""
