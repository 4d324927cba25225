"""Training-data operators (one module each), their queries and SQL. Nothing else in the library imports this."""
