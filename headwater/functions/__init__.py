"""Column functions: resource names, SQL text, scalars."""
