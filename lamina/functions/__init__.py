"""Column functions: text predicates and repairs."""
