"""Column functions: text cleaning, schema-driven casts, message framing."""
