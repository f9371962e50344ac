"""Column expressions: time arithmetic, text and predicate helpers, statistics."""
