"""Column expressions: lenient casts, aircraft predicates, window measures."""
