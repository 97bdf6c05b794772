"""Training-data operators: one module for each, with the queries and their SQL in ``queries``."""
