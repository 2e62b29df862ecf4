"""Column functions and predicates."""
