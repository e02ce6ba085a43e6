"""Column functions: calendar parts, keys, text clean-up, type coercion and code labels."""
