"""Column functions: predicates, text rules, table expressions."""
