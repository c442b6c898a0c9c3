"""Training-data operators: one module per operator, with the query each one registers."""
