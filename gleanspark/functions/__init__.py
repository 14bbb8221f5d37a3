"""Column functions: text, predicates, payload, types and errors."""
